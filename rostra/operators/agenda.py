"""A session's agenda from its notes and speeches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostra.functions.references import agenda_law, agenda_title, announces, default_title


def agenda(notes: DataFrame, speeches: DataFrame, law: Column | None = None, title: Column | None = None, announcing: Column | None = None, most: int = 25) -> DataFrame:
    """session_id, item_number, title, law_id, at most `most` items a session, in order of notes, then speeches.

    An item with a law comes once a law; one without only if no accepted item before it has its title (first
    60 characters, any case). So laws are settled first; a title is taken by the first item that has it, with
    a law that is new or without one.
    """
    law, title, announcing = (x if x is not None else y for x, y in ((law, agenda_law(F.col("text"))), (title, agenda_title(F.col("text"))), (announcing, announces(F.col("text")))))
    said = speeches.where((F.length("text") >= 40) & announcing).select("session_id", F.col("speech_index").alias("at"), "text")
    both = notes.where(F.trim("initial_notes") != "").select("session_id", F.lit(-1).cast("long").alias("at"), F.col("initial_notes").alias("text")).unionByName(said)
    found = both.select("session_id", "at", law.alias("law_id"), title.alias("found")).where("law_id is not null or found is not null")
    items = found.select("session_id", "at", "law_id", F.coalesce("found", default_title(F.col("law_id"))).alias("title")).withColumn("k", F.lower(F.left("title", F.lit(60))))
    first = F.row_number().over(Window.partitionBy("session_id", F.lower("law_id")).orderBy("at"))
    items = items.withColumn("new_law", F.col("law_id").isNotNull() & (first == 1)).where("new_law or law_id is null")
    own = F.row_number().over(Window.partitionBy("session_id", "k").orderBy("at"))
    items = items.withColumn("nth", own).where("new_law or nth = 1")
    return items.withColumn("item_number", F.row_number().over(Window.partitionBy("session_id").orderBy("at"))).where(F.col("item_number") <= most).select("session_id", "item_number", "title", "law_id")


def law_index(speeches: DataFrame, laws: Column) -> DataFrame:
    """session_id, law_id, indexes: the speeches of a session that name a law, sorted."""
    return speeches.select("session_id", "speech_index", F.explode(laws).alias("law_id")).groupBy("session_id", "law_id").agg(F.array_sort(F.collect_set("speech_index")).alias("indexes"))

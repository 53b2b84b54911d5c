"""Documents for export, as rows: one JSON text each, or typed structs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostra.functions.text import safe_name, slug


def enriched(interventions: DataFrame, analysis: DataFrame, topics: DataFrame, members: DataFrame) -> DataFrame:
    """Interventions with what is known of each, of its session and of its member."""
    return interventions.join(analysis, "intervention_id", "left").join(topics, "session_id", "left").join(members, "member_id", "left")


def member_documents(analysed: DataFrame, top: DataFrame) -> DataFrame:
    """member_id, file, document: counts, top topics and the speeches of each label, in order of session and index.

    analysed: member_id, name, party_id, session_id, session_date, speech_index, label, text; top: member_id,
    topic, count, rank.
    """
    line = F.struct("session_id", "speech_index", F.col("session_date").cast("string").alias("session_date"), "text")
    lists = [F.array_sort(F.collect_list(F.when(F.col("label") == x, line))).alias(x) for x in ("constructive", "neutral", "non_constructive")]
    g = analysed.groupBy("member_id", "name", "party_id").agg(F.count("*").alias("interventions_total"), *lists)
    t = top.groupBy("member_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "topic", "count"))), lambda x: F.struct(x["topic"].alias("topic"), x["count"].alias("count"))).alias("top_topics"))
    doc = F.struct("member_id", "name", "party_id", "interventions_total", *[F.size(x).alias(f"{x}_count") for x in ("constructive", "neutral", "non_constructive")], "top_topics", F.struct("constructive", "neutral", "non_constructive").alias("interventions"))
    return g.join(t, "member_id", "left").select("member_id", F.concat(F.lit("interventions_"), "member_id", F.lit("_"), slug(F.col("name")), F.lit(".json")).alias("file"), doc.alias("document"))


def party_documents(members: DataFrame, top: DataFrame) -> DataFrame:
    """Party, members_count, sums of the members' counts, top topics; members by total, then id."""
    listed = F.array_sort(F.collect_list(F.struct((-F.col("total")).alias("o"), "member_id", "total")))
    g = members.groupBy(F.coalesce("party", F.lit("unknown")).alias("party")).agg(
        F.count("*").alias("members_count"), *[F.sum(c).alias(c) for c in ("total", "constructive_count", "neutral_count", "non_constructive_count")], F.transform(listed, lambda x: x["member_id"]).alias("members")
    )
    t = top.groupBy("party").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "topic"))), lambda x: x["topic"]).alias("top_topics"))
    return g.join(t, "party", "left")


def session_documents(sessions: DataFrame, topics: DataFrame) -> DataFrame:
    """session_id, stenogram (its least path), source_url, topics."""
    s = sessions.groupBy("session_id").agg(F.min("path").alias("stenogram"), F.max_by("source_url", "path").alias("source_url"))
    t = topics.groupBy("session_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "topic"))), lambda x: x["topic"]).alias("topics"))
    return s.join(t, "session_id", "left").select("session_id", "stenogram", "source_url", F.coalesce("topics", F.array().cast("array<string>")).alias("topics"))


def topics_document(canonical: DataFrame, top: int = 200) -> DataFrame:
    """The topics by count and name, with their aliases."""
    return canonical.orderBy(F.desc("count"), "canonical", "key").limit(top).select("canonical", "count", "aliases")


def summary(totals: DataFrame, run_id: str) -> DataFrame:
    """The summary of a run as JSON."""
    return totals.select(F.lit(run_id).alias("run_id"), F.to_json(F.struct(F.lit(run_id).alias("run_id"), *totals.columns)).alias("summary"))


def prompt(header: Sequence[tuple[str, Column]], sections: Sequence[tuple[str, Column]]) -> Column:
    """Lines of a header, then titled sections parted by blank lines; what is null or blank is left out."""
    lines = F.concat_ws("\n", *[F.when(c.isNotNull() & (F.trim(c) != ""), F.concat(F.lit(f"{k}: "), c)) for k, c in header])
    parts = [F.when(c.isNotNull() & (F.trim(c) != ""), F.concat(F.lit(f"## {k}\n"), c)) for k, c in sections]
    return F.concat_ws("\n\n", lines, *parts)


def context_lines(context: Column) -> Column:
    """An array of (speaker, text), a line each."""
    return F.array_join(F.transform(context, lambda x: F.concat(F.lit("- ["), x["raw_speaker"], F.lit("] "), x["text"])), "\n")


def prompt_file(kind: str, date: Column, session: Column, stamp: Column, model: Column, label: Column) -> Column:
    """Kind, date, session, time, model and label, parted by underscores."""
    return F.concat(F.concat_ws("_", F.lit(kind), date.cast("string"), session, stamp, safe_name(model), safe_name(label)), F.lit(".txt"))


def productivity_documents(productivity: DataFrame) -> DataFrame:
    """Level, file, document: one for the total and its populations, one a member and one a party."""
    names = [c for c in productivity.columns if c not in ("level",)]
    file = (
        F.when(F.col("level") == "member", F.concat(F.lit("productivity_members/"), "member_id", F.lit(".json")))
        .when(F.col("level") == "party", F.concat(F.lit("productivity_parties/"), F.lower(F.regexp_replace("party_id", "[^A-Za-z0-9]+", "-")), F.lit(".json"))).otherwise("productivity_total.json")
    )
    return productivity.select("level", file.alias("file"), F.struct(*names).alias("document"))


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON line a document, in a folder that is replaced."""
    documents.write.mode("overwrite").json(path)

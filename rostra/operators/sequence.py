"""Speeches in order: context, interruptions, and merging what an interruption cut."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostra.functions.text import agent_key, hits, holds_any, or_empty, plain_words, stripped

# What the chair says, in normal form, by kind of interruption; and short replies and insults.
TIME_MARKERS = [
    "a expirat timpul", "timpul regulamentar", "depasit timpul", "incadrati in", "va rog sa finalizati", "va rog sa concluzionati", "va rog sa terminati",
    "va rog sa incheiat", "trebuie sa incheiem", "doua minute", "un minut", "i se intrerupe microfonul", "intrerupe microfonul",
]
PROCEDURE_MARKERS = ["regulament", "nu este la subiect", "nu vorbiti la subiect", "ramaneti la subiect", "la subiect", "retrag cuvantul", "nu aveti dreptul", "nu ati solicitat", "fara drept de cuvant"]
ROUTINE_MARKERS = ["se pregateste", "are cuvantul", "propuneri la ordinea de zi", "intram in ordinea de zi", "declar inchisa sedinta", "dezapasati", "domnul deputat", "doamna deputat"]
WEAK_ROUTINE_MARKERS = ["multumesc", "multumim", "va rog"]
SHORT_REPLIES = ["da", "nu", "prezent", "absent", "abtinere", "contra", "pentru"]
SHORT_ATTACKS = ["hot", "hoti", "hotilor", "rusine", "mincinos", "mincinoasa", "corupt", "corupti", "penal", "penali", "tradator", "tradatori", "mafiot", "mafioti"]


def interruption_type(text: Column, time: Sequence[str] = TIME_MARKERS, procedure: Sequence[str] = PROCEDURE_MARKERS, routine: Sequence[str] = ROUTINE_MARKERS) -> Column:
    """time_overrun, procedure_violation, routine, or null for what isn't a chair's interruption (above 300 characters never)."""
    key = agent_key(text)
    words = plain_words(key)
    n, first, last = F.size(words), F.try_element_at(words, F.lit(1)), F.try_element_at(words, F.lit(-1))
    attacked = F.exists(words, lambda w: w.isin(SHORT_ATTACKS))
    is_routine = (
        holds_any(key, routine) | (holds_any(key, WEAK_ROUTINE_MARKERS) & (n <= 8)) | ((n <= 4) & last.isin(SHORT_REPLIES) & ~attacked)
        | ((n <= 4) & first.isin("domnul", "doamna")) | (F.contains(key, F.lit("ordinea de zi")) & (n <= 6)) | (F.contains(key, F.lit("procedura")) & (n <= 5))
    )
    return F.when((key == "") | (n == 0) | (F.length(key) > 300), None).when(holds_any(key, time), "time_overrun").when(holds_any(key, procedure), "procedure_violation").when(is_routine, "routine")


def continues(text: Column) -> Column:
    """Begins with an ellipsis or a small letter."""
    return or_empty(text).rlike(r"(?U)^\s*(\.\.\.|…|\p{Ll})")


def microphone(text: Column) -> Column:
    """W5."""
    return F.contains(agent_key(text), F.lit("microfonul"))


def previous(speeches: DataFrame, most: int = 9, immediate: int = 3) -> DataFrame:
    """The speeches before each, up to `most`: the last `immediate`, and those earlier."""
    w = Window.partitionBy("session_id").orderBy("speech_index").rowsBetween(-most, -1)
    c = F.collect_list("speech_index").over(w)
    cut = F.greatest(F.size("context") - immediate, F.lit(0))
    return speeches.select("session_id", "speech_index", c.alias("context")).select("*", F.slice("context", F.lit(1), cut).alias("earlier"), F.slice("context", cut + 1, F.lit(immediate)).alias("immediate"))


def merge_continuations(speeches: DataFrame, kind: Callable[[Column], Column] = interruption_type, marker: Callable[[Column], Column] = microphone) -> DataFrame:
    """session_id, speech_index, merged_text, merged_indices, interruption_type.

    A speech goes on from the one two places before if the same speaker gave both and the one between is an
    interruption: one for time always, a routine one if the speech begins like a continuation or one of the
    other two speaks of the microphone. Links depend on three neighbours only, so chains are islands of
    every second place of a session. An interruption for procedure ends a chain and is reported.
    """
    order = Window.partitionBy("session_id").orderBy("speech_index")
    who, text = stripped(or_empty(F.col("raw_speaker"))), stripped(or_empty(F.col("text")))
    s = speeches.select("session_id", "speech_index", who.alias("who"), text.alias("t"), kind(F.col("text")).alias("kind"), marker(F.col("text")).alias("mic"), continues(F.col("text")).alias("goes_on"), F.row_number().over(order).alias("place"))
    s = s.select("*", *[F.lag(c, k).over(order).alias(f"{c}{k}") for c, k in (("who", 1), ("who", 2), ("kind", 1), ("mic", 1), ("mic", 2))])
    same = (F.col("who2") == F.col("who")) & (F.col("t") != "")
    strong = F.col("goes_on") | F.col("mic1") | F.col("mic2")
    link = F.coalesce(same & ((F.col("kind1") == "time_overrun") | ((F.col("kind1") == "routine") & strong)), F.lit(False))
    stop = F.coalesce(same & (F.col("kind1") == "procedure_violation"), F.lit(False))
    every2 = Window.partitionBy("session_id", F.col("place") % 2).orderBy("place")
    s = s.withColumn("link", link).withColumn("stop", stop).withColumn("island", F.sum((~F.col("link")).cast("int")).over(every2.rowsBetween(Window.unboundedPreceding, 0)))
    chain = Window.partitionBy("session_id", F.col("place") % 2, "island").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    parts = F.filter(F.collect_list("t").over(chain), lambda x: x != "")
    late = F.max(F.when(F.col("link") & (F.col("kind1") == "time_overrun"), 1).otherwise(0)).over(chain)
    found = F.when(F.first("stop").over(chain), "procedure_violation").when(F.col("link"), F.when(late == 1, "time_overrun").otherwise("routine"))
    return s.select("session_id", "speech_index", F.array_join(parts, "\n\n").alias("merged_text"), F.collect_list("speech_index").over(chain).alias("merged_indices"), found.alias("interruption_type"))


def early(speeches: DataFrame, below: int = 30) -> DataFrame:
    """By index, whatever is missing."""
    return speeches.where(F.col("speech_index") < below)


def top_k(rows: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """W7."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= k)


def marker_counts(text: Column, lists: dict[str, Sequence[str]]) -> Column:
    return F.struct(*[hits(agent_key(text), v).alias(k) for k, v in lists.items()])

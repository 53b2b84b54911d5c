"""Keyed writes without MERGE, pending work, and changed files: each gives the new state as a DataFrame.

Write the result to a fresh folder and swap; nothing is changed in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_by(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row of each key."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows, and old ones of other keys."""
    return new.unionByName(old.join(new.select(*keys), [*keys], "left_anti"))


def guarded_upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], column: str, owner: str) -> DataFrame:
    """B2: an old row stays if its `column` isn't `owner`."""
    kept = old.where(F.col(column) != owner)
    return upsert(old, new.join(kept.select(*keys), [*keys], "left_anti"), keys)


def accumulate(old: DataFrame, new: DataFrame, keys: Sequence[str], total: str, label: str) -> DataFrame:
    """Sums by key; the label of the latest."""
    both = old.withColumn("_at", F.lit(0)).unionByName(new.withColumn("_at", F.lit(1)))
    return both.groupBy(*keys).agg(F.sum(total).alias(total), F.max_by(label, F.struct("_at", label)).alias(label))


def insert_new(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of keys that aren't there."""
    return old.unionByName(new.join(old.select(*keys), [*keys], "left_anti"))


def changed_rows(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose content differs from what is stored; writing the others would change nothing."""
    rest = sorted(c for c in new.columns if c not in keys)
    mark = lambda df: df.withColumn("_h", F.sha2(F.to_json(F.struct(*rest)), 256))
    return mark(new).join(mark(old).select(*keys, "_h"), [*keys, "_h"], "left_anti").drop("_h")


def pending(work: DataFrame, done: DataFrame, keys: Sequence[str], finished: Column | None = None) -> DataFrame:
    """Work that isn't done."""
    return work.join((done if finished is None else done.where(finished)).select(*keys), [*keys], "left_anti")


def without(rows: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What stays of rows when those of `gone` are deleted."""
    return rows.join(gone.select(*keys), [*keys], "left_anti")


def missing(wanted: DataFrame, tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Keys that any of the tables lacks."""
    out = None
    for t in tables:
        lacks = wanted.select(key).join(t.select(key), key, "left_anti")
        out = lacks if out is None else out.unionByName(lacks)
    return out.distinct()


def candidates(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Path, content_hash, reason: files that are new, or whose content isn't that of the ledger."""
    old = ledger.select("path", F.col("content_hash").alias("known"))
    reason = F.when(F.col("known").isNull(), "new").when(F.col("known") != F.col("content_hash"), "changed")
    return files.join(old, "path", "left").withColumn("reason", reason).where("reason is not null").select("path", "content_hash", "reason")


def run_states(events: DataFrame) -> DataFrame:
    """The state of each run by its latest event; a run that has failed or completed may start again."""
    return events.groupBy("run_id").agg(F.max_by("status", "at").alias("status"), F.min("at").alias("started_at"), F.max("at").alias("updated_at"))


def append(history: DataFrame, runs: DataFrame, renamed: dict[str, str]) -> DataFrame:
    """History and new runs; columns of an older shape get their new names, missing ones are null."""
    old = history.withColumnsRenamed({a: b for a, b in renamed.items() if a in history.columns})
    return old.unionByName(runs, allowMissingColumns=True)


def reprocess(work: DataFrame, done: DataFrame, keys: Sequence[str], source: Column, model: str | None = None) -> DataFrame:
    """Work that no model has done, or, with `model`, that this one hasn't."""
    return pending(work, done, keys, source.startswith("llm_v1:") if model is None else source == f"llm_v1:{model}")


def cleared(table: DataFrame) -> DataFrame:
    """An empty table of the same shape."""
    return table.limit(0)


def looked_up(targets: DataFrame, interventions: DataFrame) -> DataFrame:
    """The id of each target (session_id, speech_index); those without one have found = false."""
    ids = interventions.select("session_id", "speech_index", "intervention_id")
    return targets.join(ids, ["session_id", "speech_index"], "left").withColumn("found", F.col("intervention_id").isNotNull())

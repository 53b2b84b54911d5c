"""Who spoke: a cascade of key joins from raw speaker to member."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostra.functions.text import speaker_key, token_key


def _unique(members: DataFrame, key: Column, name: str) -> DataFrame:
    """The keys that one member alone has."""
    return members.select(key.alias(name), "member_id").groupBy(name).agg(F.min("member_id").alias(f"{name}_member"), F.count("*").alias("n")).where("n = 1").drop("n")


def alias_key(key: Column) -> Column:
    """A name's key with its first word last."""
    words = F.split(key, " ")
    return F.when(F.size(words) > 1, F.concat_ws(" ", F.array_join(F.slice(words, F.lit(2), F.size(words)), " "), F.element_at(words, 1)))


def resolve_speakers(speeches: DataFrame, members: DataFrame) -> DataFrame:
    """Speeches with speaker_key, resolved_id and resolved_by (exact, alias, token or null).

    A key that several members have says nothing and falls through to the next kind. The registry sides are
    aggregates, so adaptive execution broadcasts them where their measured size allows.
    """
    named = members.select("member_id", speaker_key(F.col("name")).alias("key"))
    exact, alias, token = (_unique(named, k, n) for k, n in ((F.col("key"), "exact"), (alias_key(F.col("key")), "alias"), (token_key(F.col("key")), "token")))
    keyed = speeches.withColumn("speaker_key", speaker_key(F.col("raw_speaker")))
    found = keyed.join(exact, F.col("speaker_key") == F.col("exact"), "left").join(alias, F.col("speaker_key") == F.col("alias"), "left").join(token, token_key(F.col("speaker_key")) == F.col("token"), "left")
    by = F.when(F.col("exact_member").isNotNull(), "exact").when(F.col("alias_member").isNotNull(), "alias").when(F.col("token_member").isNotNull(), "token")
    return found.withColumn("resolved_id", F.coalesce("exact_member", "alias_member", "token_member")).withColumn("resolved_by", by).drop("exact", "exact_member", "alias", "alias_member", "token", "token_member")


def unmatched(resolved: DataFrame) -> DataFrame:
    """D3: how often each unresolved speaker that isn't blank occurs."""
    return resolved.where("resolved_id is null and speaker_key <> ''").groupBy("session_id", "raw_speaker", "speaker_key").agg(F.count("*").alias("occurrences"))


def run_totals(resolved: DataFrame) -> DataFrame:
    """Sessions, speeches, matched, unmatched and blank; matched is what isn't unmatched, as in the run summary, and resolved what is."""
    un = F.col("resolved_id").isNull() & (F.col("speaker_key") != "")
    return resolved.agg(
        F.count_distinct("session_id").alias("sessions"), F.count("*").alias("speeches"), F.count_if(~un).alias("matched"), F.count_if(un).alias("unmatched"), F.count_if(F.col("resolved_id").isNotNull()).alias("resolved")
    )

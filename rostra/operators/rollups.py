"""Productivity and label counts by member, party and population."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostra.functions.text import letter_count, word_count


def _sums() -> list[Column]:
    out = [F.count("*").alias("interventions")]
    for label in ("constructive", "non_constructive"):
        out.append(F.count_if(F.col("label") == label).alias(f"{label}_interventions"))
    for kind in ("word", "letter"):
        out.append(F.sum(f"{kind}s").alias(f"total_{kind}_count"))
        out += [F.coalesce(F.sum(F.when(F.col("label") == x, F.col(f"{kind}s"))), F.lit(0)).alias(f"{x}_{kind}_count") for x in ("constructive", "non_constructive")]
    return out


def _ratios(df: DataFrame) -> DataFrame:
    """null where the denominator is 0; percentages of two digits."""
    parts = {"word_productivity": ("constructive_word_count", "total_word_count"), "letter_productivity": ("constructive_letter_count", "total_letter_count"), "counterproductiveness": ("non_constructive_letter_count", "total_letter_count")}
    for name, (a, b) in parts.items():
        df = df.withColumn(f"{name}_ratio", F.try_divide(F.col(a), F.col(b))).withColumn(f"{name}_pct", F.round(F.col(f"{name}_ratio") * 100, 2))
    return df


def measured(analysed: DataFrame) -> DataFrame:
    """Words and letters of each analysed speech (label, member_id, party_id, text)."""
    return analysed.withColumn("words", word_count(F.col("text")).cast("long")).withColumn("letters", letter_count(F.col("text")).cast("long"))


def productivity(analysed: DataFrame) -> DataFrame:
    """One pass over the speeches gives members in parties, parties, members and others, and all.

    level says which: member, party, population or total.
    """
    m = measured(analysed).withColumn("is_member", F.col("member_id").isNotNull())
    g = m.groupingSets([[F.col("party_id"), F.col("member_id")], [F.col("party_id")], [F.col("is_member")], []], F.col("party_id"), F.col("member_id"), F.col("is_member"))
    held = g.agg(F.grouping_id().alias("gid"), *_sums())
    # Bits, high to low: party, member, is_member; a bit is 1 where its column is summed over.
    level = F.when(F.col("gid") == 1, "member").when(F.col("gid") == 3, "party").when(F.col("gid") == 6, "population").otherwise("total")
    return _ratios(held.withColumn("level", level).drop("gid")).where("level in ('population', 'total') or party_id is not null")


def ranked(entries: DataFrame, key: str) -> DataFrame:
    """By percentage (null as -1), letters and id."""
    return entries.orderBy(F.coalesce("letter_productivity_pct", F.lit(-1.0)).desc(), F.desc("total_letter_count"), F.col(key))


def label_counts(analysed: DataFrame, keys: list[str]) -> DataFrame:
    """How many speeches of each label."""
    return analysed.groupBy(*keys).agg(F.count("*").alias("total"), *[F.count_if(F.col("label") == x).alias(f"{x}_count") for x in ("constructive", "neutral", "non_constructive")])


def party_topics(member_topics: DataFrame, members: DataFrame, top: int = 20) -> DataFrame:
    """Sums of the members' own top lists, as exported; members without a party are `unknown`."""
    from pyspark.sql import Window

    c = member_topics.join(members.select("member_id", "party_id"), "member_id").groupBy(F.coalesce("party_id", F.lit("unknown")).alias("party"), "topic").agg(F.sum("count").alias("count"))
    return c.withColumn("rank", F.row_number().over(Window.partitionBy("party").orderBy(F.desc("count"), "topic"))).where(F.col("rank") <= top)

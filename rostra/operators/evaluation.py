"""Predictions held against a gold set, and checks of what was exported."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.functions.text import evaluation_topic, law_form, rules_key
from rostra.operators.rules import LABELS

BUCKETS = [("0.00-0.50", 0.0, 0.5), ("0.50-0.65", 0.5, 0.65), ("0.65-0.80", 0.65, 0.8), ("0.80-1.00", 0.8, 1.01)]


def with_predictions(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """Each gold speech with its prediction, if it has one."""
    return gold.join(predictions, ["session_id", "speech_index"], "left")


def confusion(rows: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """A row for each expected label, a column for each predicted one."""
    counts = rows.groupBy("expected_label").pivot("predicted", [*labels]).count()
    return counts.na.fill(0)


def per_label(rows: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Precision, recall, F1 and support; 0 where nothing is to be divided."""
    each = rows.select("expected_label", "predicted", F.explode(F.array(*map(F.lit, labels))).alias("label"))
    e, p = F.col("expected_label") == F.col("label"), F.col("predicted") == F.col("label")
    c = each.groupBy("label").agg(F.count_if(e & p).alias("tp"), F.count_if(~e & p).alias("fp"), F.count_if(e & ~p).alias("fn"))
    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    c = c.withColumn("precision", zero(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", zero(F.col("tp"), F.col("tp") + F.col("fn")))
    return c.select("label", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"), F.round(zero(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), 6).alias("f1"), (F.col("tp") + F.col("fn")).alias("support"))


def coverage(rows: DataFrame) -> DataFrame:
    """Of all gold speeches."""
    return rows.agg(F.count("*").alias("total"), F.count("predicted").alias("evaluated"), F.count_if(F.col("predicted").isNull()).alias("skipped"), F.round(F.try_divide(F.count("predicted"), F.count("*")) * 100, 1).alias("coverage_pct"), F.count_if(F.col("predicted") == F.col("expected_label")).alias("correct"))


def overlap(expected: Column, predicted: Column) -> Column:
    """Topics in common, only predicted, only expected, in normal form."""
    a, b = (F.array_distinct(F.filter(F.transform(x, evaluation_topic), lambda t: t != "")) for x in (expected, predicted))
    return F.struct(F.size(F.array_intersect(a, b)).alias("tp"), F.size(F.array_except(b, a)).alias("fp"), F.size(F.array_except(a, b)).alias("fn"))


def law_matches(expected: Column, predicted: Column) -> Column:
    """Expected references found as they are, in part (contained, or the same number), or missed."""
    form = lambda c: law_form(rules_key(c))
    known = F.transform(F.filter(predicted, lambda p: F.coalesce(p, F.lit("")) != ""), form)

    def partly(e):
        numbers = F.regexp_extract_all(e, F.lit(r"(\d+/\d{4})"), F.lit(1))
        return F.exists(known, lambda p: (F.length(p) >= 6) & (F.contains(p, e) | F.contains(e, p))) | F.exists(known, lambda p: F.exists(numbers, lambda n: F.contains(p, n)))

    kinds = F.transform(F.transform(expected, form), lambda e: F.when(F.array_contains(known, e), "exact").when(partly(e), "partial").otherwise("missed"))
    n = lambda kind: F.size(F.filter(kinds, lambda k: k == kind))
    return F.struct(F.size(kinds).alias("expected"), n("exact").alias("exact_match"), n("partial").alias("partial_match"), n("missed").alias("missed"))


def calibration(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """How many of each range of confidence there are, and how many are right; empty ranges too."""
    name = F.coalesce(*[F.when((F.col("confidence") >= a) & (F.col("confidence") < b), n) for n, a, b in BUCKETS])
    held = rows.groupBy(name.alias("bucket")).agg(F.count("*").alias("n"), F.round(F.avg((F.col("predicted") == F.col("expected_label")).cast("double")), 6).alias("accuracy"))
    every = spark.createDataFrame([(n,) for n, _, _ in BUCKETS], "bucket string")
    return every.join(held, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"), "accuracy")


def violations(members: DataFrame, parties: DataFrame, topics: DataFrame, most: int = 20) -> DataFrame:
    """Rule and key of what is wrong in exported counts; empty if all is well.

    members: member_id, party, total and three label counts; parties: party and the same sums; topics:
    member_id, rank, topic, count.
    """
    from pyspark.sql import Window

    parts = F.col("constructive_count") + F.col("neutral_count") + F.col("non_constructive_count")
    sums = members.where(F.col("total") != parts).select(F.lit("label_sum").alias("rule"), F.col("member_id").alias("key"))
    keys = members.where(F.col("member_id").isNull() | (F.col("member_id") == "")).select(F.lit("missing_key").alias("rule"), F.col("member_id").alias("key"))
    w = Window.partitionBy("member_id").orderBy("rank")
    before, name = F.lag("count").over(w), F.lag("topic").over(w)
    order = topics.withColumn("bad", (before < F.col("count")) | ((before == F.col("count")) & (name > F.col("topic")))).where("bad").select(F.lit("unsorted_topics").alias("rule"), F.col("member_id").alias("key"))
    many = topics.groupBy("member_id").count().where(F.col("count") > most).select(F.lit("too_many_topics").alias("rule"), F.col("member_id").alias("key"))
    own = members.groupBy("party").agg(F.sum("total").alias("sum"))
    party = parties.join(own, "party", "full_outer").where(~F.col("total").eqNullSafe(F.col("sum"))).select(F.lit("party_sum").alias("rule"), F.col("party").alias("key"))
    return sums.unionByName(keys).unionByName(order).unionByName(many).unionByName(party)


def dangling(rows: DataFrame, known: DataFrame) -> DataFrame:
    """C20: evidence ids of rows (id, session_id, evidence) that no chunk of the same session has."""
    e = rows.select("id", "session_id", F.explode("evidence").alias("chunk_id"))
    return e.join(known.select("session_id", "chunk_id"), ["session_id", "chunk_id"], "left_anti")

"""The driver's tables in the shapes of the domain, and the same as DuckDB views for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """member_id, number, chamber, name, party_id."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    chamber = F.when(F.col("s_suppkey") % 2 == 0, "deputat").otherwise("senator")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(
        F.concat(chamber, F.lit("_"), "s_suppkey").alias("member_id"), F.col("s_suppkey").alias("number"), chamber.alias("chamber"),
        F.replace("s_name", F.lit("#"), F.lit(" ")).alias("name"), F.col("n_name").alias("party_id"),
    )


def speeches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """session_id, speech_index, session_date, role, raw_speaker, member_id, text."""
    m = members(spark, sf_dir)
    c = table(spark, sf_dir, "conversations")
    who = F.pmod(F.col("conv_id") * 2 + F.when(F.col("role") == "user", 0).when(F.col("role") == "assistant", 1).otherwise(2), m.agg(F.count("*")).scalar()) + m.agg(F.min("number")).scalar()
    turned = F.concat_ws(" ", F.element_at(F.split("name", " "), 2), F.element_at(F.split("name", " "), 1))
    kind = F.col("turn") % 4
    raw = (
        F.when((F.col("conv_id") + F.col("turn")) % 7 == 6, F.concat(F.lit("Guest "), F.col("turn")))
        .when(kind == 0, F.concat(F.lit("Domnul "), "name")).when(kind == 1, F.concat(F.lit("Doamna "), turned, F.lit(" (din sala)")))
        .when(kind == 2, F.concat("name", F.lit(" - ministru"))).otherwise(F.replace(turned, F.lit(" "), F.lit(", ")))
    )
    return (
        c.withColumn("number", who).join(m, "number")
        .select(F.col("conv_id").cast("string").alias("session_id"), F.col("turn").cast("long").alias("speech_index"),
                F.date_add(F.lit("2024-01-01").cast("date"), (F.col("conv_id") % 30).cast("int")).alias("session_date"),
                "role", raw.alias("raw_speaker"), "member_id", "text")
    )


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, expected_label, predicted, confidence, text."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    text = F.col("text")
    return d.select(
        "doc_id", F.when(F.col("toxic") == 1, "non_constructive").when(F.col("quality") == 1, "constructive").otherwise("neutral").alias("expected_label"),
        F.when(F.contains(text, F.lit("!!")) | F.contains(text, F.lit("token =")), "non_constructive").when(F.col("n_chars") < 300, "neutral").otherwise("constructive").alias("predicted"),
        ((F.col("n_chars") % 101) / 100.0).alias("confidence"), "text",
    )


#: Speech-shaped views for DuckDB.
MEMBERS_SQL = """members AS (
  SELECT (CASE WHEN s_suppkey % 2 = 0 THEN 'deputat' ELSE 'senator' END) || '_' || s_suppkey AS member_id, s_suppkey AS number,
    CASE WHEN s_suppkey % 2 = 0 THEN 'deputat' ELSE 'senator' END AS chamber, replace(s_name, '#', ' ') AS name, n_name AS party_id
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
SPEECHES_SQL = (
    MEMBERS_SQL
    + """, numbered AS (
  SELECT *, (conv_id * 2 + CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 ELSE 2 END) % (SELECT count(*) FROM members) + (SELECT min(number) FROM members) AS number FROM conversations),
speeches AS (
  SELECT conv_id::VARCHAR AS session_id, turn AS speech_index, (DATE '2024-01-01' + (conv_id % 30)::INTEGER)::DATE AS session_date, role,
    CASE WHEN (conv_id + turn) % 7 = 6 THEN 'Guest ' || turn WHEN turn % 4 = 0 THEN 'Domnul ' || name
      WHEN turn % 4 = 1 THEN 'Doamna ' || split_part(name, ' ', 2) || ' ' || split_part(name, ' ', 1) || ' (din sala)'
      WHEN turn % 4 = 2 THEN name || ' - ministru' ELSE split_part(name, ' ', 2) || ', ' || split_part(name, ' ', 1) END AS raw_speaker, member_id, text
  FROM numbered JOIN members USING (number))"""
)
GOLD_SQL = """gold AS (
  SELECT doc_id, CASE WHEN toxic = 1 THEN 'non_constructive' WHEN quality = 1 THEN 'constructive' ELSE 'neutral' END AS expected_label,
    CASE WHEN contains(text, '!!') OR contains(text, 'token =') THEN 'non_constructive' WHEN n_chars < 300 THEN 'neutral' ELSE 'constructive' END AS predicted,
    (n_chars % 101) / 100.0::DOUBLE AS confidence, text
  FROM documents JOIN labels USING (doc_id))"""

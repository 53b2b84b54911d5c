"""The registered queries of the corpus operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.llm.common import crc_fold, table


def op1_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rostra.llm.repeats import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), 200)


def op2_chain_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rostra.llm.langid import fit, with_language

    docs = table(spark, sf_dir, "documents")
    held_out = crc_fold(docs["doc_id"], 4) == 2
    read = with_language(docs.select("doc_id", held_out.alias("held_out"), "text"), fit(docs, ~held_out))
    return read.select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), "language.score", "language.switches")


def op3_nearest_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rostra.llm.toxicity import fit, with_toxicity

    docs = table(spark, sf_dir, "documents")
    held_out = crc_fold(docs["doc_id"], 3) == 1
    labels = table(spark, sf_dir, "labels")
    index = fit(docs, labels.where(crc_fold(labels["doc_id"], 3) != 1))
    scored = with_toxicity(docs.select("doc_id", held_out.alias("held_out"), "text"), index)
    return scored.select("doc_id", "held_out", "toxicity.score", "toxicity.predicted", F.expr("transform(toxicity.evidence, x -> x.doc_id)").alias("nearest"))


def op4_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rostra.llm.quality import rate_quality

    return rate_quality(table(spark, sf_dir, "documents"))


def op5_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rostra.llm.sharding import shard_manifest

    return shard_manifest(table(spark, sf_dir, "documents"), 24)


def op6_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rostra.llm.mixing import mix_manifest

    return mix_manifest(table(spark, sf_dir, "documents"))


def op7_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rostra.llm.pii import with_pseudonyms

    return with_pseudonyms(table(spark, sf_dir, "documents").select("doc_id", "text"), key="fixture key")


def op8_gram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rostra.llm.decontam import benchmark_hits

    return benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rostra.llm.simhash import simhash_groups

    return simhash_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rostra.llm.linededup import dedup_lines

    lines = dedup_lines(table(spark, sf_dir, "documents"))
    return lines.select("doc_id", "n_lines", "n_copies", "n_near", F.sha2("text", 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op")}


#: Bytes of a text, as numbers, then folded through the table of the reflected polynomial 0xEDB88320.
_CRC = """
crc_table AS (
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
coded AS (
  SELECT row_number() OVER () AS rid, doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size,
    flatten(list_transform(regexp_extract_all(coalesce(text, ''), '(?s).'), lambda ch: list_transform([unicode(ch)::BIGINT], lambda u:
      CASE WHEN u < 128 THEN [u] WHEN u < 2048 THEN [192 + (u >> 6), 128 + (u & 63)]
        WHEN u < 65536 THEN [224 + (u >> 12), 128 + ((u >> 6) & 63), 128 + (u & 63)]
        ELSE [240 + (u >> 18), 128 + ((u >> 12) & 63), 128 + ((u >> 6) & 63), 128 + (u & 63)] END)[1])) AS b
  FROM documents),
summed AS (
  SELECT rid, doc_id, size, xor(4294967295, list_reduce([4294967295::BIGINT] || b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS text_crc32
  FROM coded, crc_table)"""


def _jump(shards: int) -> str:
    return f"""
jump{shards} AS (
  SELECT rid, key, -1::BIGINT AS b, 0::BIGINT AS j FROM keyed
  UNION ALL
  SELECT rid, next, j, floor((j + 1) * (2147483648::DOUBLE / ((next >> 33) + 1)::DOUBLE))::BIGINT
  FROM (SELECT rid, j, ((key * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT) AS next FROM jump{shards} WHERE j < {shards}))"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_jump_sharding": f"""
WITH RECURSIVE {_CRC},
keyed AS (SELECT rid, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 16))::UBIGINT::HUGEINT AS key FROM summed),
{_jump(24)}, {_jump(25)},
put AS (
  SELECT doc_id, size, text_crc32, a.shard, g.shard AS grown_shard FROM summed
  JOIN (SELECT rid, max(b) AS shard FROM jump24 GROUP BY rid) a USING (rid)
  JOIN (SELECT rid, max(b) AS shard FROM jump25 GROUP BY rid) g USING (rid))
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
  (row_number() OVER (PARTITION BY shard ORDER BY (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 17, 8))::BIGINT + text_crc32) % 256, doc_id NULLS FIRST, text_crc32, size) - 1)::BIGINT AS slot, grown_shard::INTEGER AS grown_shard
FROM put""",
    }

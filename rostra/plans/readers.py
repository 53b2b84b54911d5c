"""Queries of the readers, over files that the query itself writes from the tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.fixtures import MEMBERS_SQL, SPEECHES_SQL, members, speeches, table
from rostra.operators import topics as P
from rostra.plans.registry import query
from rostra.plans.scalar import FOLD
from rostra.sources import registry


def _written(lines: DataFrame) -> str:
    """A folder under the session's shared one with the rows as text, a file for each part; deleted when the driver ends."""
    spark = lines.sparkSession
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/files-{uuid.uuid4().hex}"
    lines.write.partitionBy("part").text(path)
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def _said(spark: SparkSession, text: str) -> str:
    return _written(spark.createDataFrame([(0, text)], "part int, value string"))


@query(
    "a01_registry",
    f"WITH {MEMBERS_SQL} SELECT 'senator_' || CASE WHEN number % 3 = 0 THEN 's' || number ELSE sha1(name) END AS member_id, 'senator' AS chamber, CASE WHEN number % 3 = 0 THEN 's' || number ELSE sha1(name) END AS source_member_id, name, party_id, CASE WHEN number % 5 = 0 THEN number ELSE 0 END AS bills_authored_total, (number % 4)::BIGINT AS amendments_added_total FROM members WHERE number % 7 <> 0",
)
def read_registry(spark, sf_dir):
    n = F.col("number")
    one = F.struct(
        F.when(n % 3 == 0, F.concat(F.lit("s"), n)).alias("id"), F.when(n % 7 == 0, " ").otherwise(F.col("name")).alias("name"), F.col("party_id").alias("party"),
        F.when(n % 5 == 0, n.cast("string")).otherwise("many").alias("bills_authored"), (n % 4).cast("string").alias("amendments_count"),
    )
    files = members(spark, sf_dir).groupBy((n % 2).alias("part")).agg(F.to_json(F.struct(F.collect_list(one).alias("members"))).alias("value"))
    return registry.read_registry(spark, _written(files), "senator").drop("profile_url", "circumscriptie")


@query("a04_transcripts", f"WITH {SPEECHES_SQL} SELECT session_id, session_date, 'Notes of ' || session_id AS initial_notes, (row_number() OVER (PARTITION BY session_id ORDER BY speech_index) - 1)::INTEGER AS speech_index, raw_speaker, trim(text, ' ' || chr(10)) || ' and more' AS text FROM speeches")
def read_transcripts(spark, sf_dir):
    said = F.array_sort(F.collect_list(F.struct("speech_index", F.col("raw_speaker").alias("speaker"), "text")))
    one = F.struct("session_id", F.col("session_date").cast("string").alias("stenograma_date"), F.concat(F.lit("Notes of "), "session_id").alias("initial_notes"),
                   F.transform("said", lambda x: F.struct(x["speaker"].alias("speaker"), x["text"].alias("text"), F.lit("  ").alias("text2"), F.lit("and more").alias("text3"))).alias("speeches"))
    sessions = speeches(spark, sf_dir).groupBy("session_id", "session_date").agg(said.alias("said"))
    files = sessions.groupBy((F.col("session_id").cast("long") % 8).alias("part")).agg(F.to_json(F.collect_list(one)).alias("value"))
    return registry.read_sessions(spark, _written(files)).drop("path", "source_url")


@query("a05_paths", "SELECT url || '#' || page_id AS path FROM pages WHERE page_id % 3 = 0")
def read_paths(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").where("page_id % 3 = 0")
    files = pages.groupBy((F.col("page_id") % 4).alias("part")).agg(F.to_json(F.struct(F.collect_list(F.concat_ws("#", "url", "page_id")).alias("files"))).alias("value"))
    return registry.read_paths(spark, _written(files)).select("path")


@query("a13_id_list", "SELECT doc_id::VARCHAR AS id FROM labels UNION SELECT lang FROM documents")
def read_ids(spark, sf_dir):
    ids = table(spark, sf_dir, "labels").groupBy(F.lit(0).alias("part")).agg(F.to_json(F.collect_list(F.concat(F.lit(" "), F.col("doc_id").cast("string")))).alias("value"))
    langs = table(spark, sf_dir, "documents").groupBy(F.lit(1).alias("part")).agg(F.concat_ws("\n\n", F.collect_set("lang"), F.collect_set("lang")).alias("value"))
    return registry.read_ids(spark, _written(ids.unionByName(langs))).select("id").distinct()


_TAXONOMY = {
    "topic_stopwords": ["and"], "token_equivalents": {"thing": "matter", "tions": "motion"},
    "direction_rules": [{"label": "things", "mapped_tokens": ["matter"], "raw_roots": ["ation"]}, {"label": "other", "mapped_tokens": [], "raw_roots": ["x"]}],
    "catalog_topics": [{"id": "a", "label": "things", "description": "d", "aliases": ["the things"]}, {"id": "b", "label": "Motión", "description": "", "aliases": []}],
}


@query("a07_taxonomy_keywords", f"WITH k AS (SELECT * FROM (VALUES (0, 'things', 'things'), (0, 'things', 'the things'), (0, 'things', 'ation'), (0, 'things', 'matter'), (0, 'things', 'thing'), (1, 'Motión', 'motion')) v(rank, topic, keyword)) SELECT doc_id, rank, topic, count(*) AS met FROM documents JOIN k ON contains({FOLD}, keyword) GROUP BY ALL")
def taxonomy_keywords(spark, sf_dir):
    from rostra.functions.text import analysis_text

    words = P.keywords(P.read_taxonomy(spark, _said(spark, json.dumps(_TAXONOMY, indent=1))).drop("part")).groupBy().agg(F.collect_list(F.struct("rank", "topic", "keyword")).alias("k"))
    d = table(spark, sf_dir, "documents").withColumn("key", analysis_text(F.col("text"))).withColumn("k", words.scalar())
    met = d.select("doc_id", F.explode(F.filter("k", lambda w: F.contains(F.col("key"), w["keyword"]))).alias("w"))
    return met.groupBy("doc_id", "w.rank", "w.topic").agg(F.count("*").alias("met"))


@query("a09_topic_catalog", "SELECT * FROM (VALUES ('catalog', 'a', 'things', 1), ('catalog', 'b', 'Motión', 0), ('rules', 'dir_01', 'things', 0), ('rules', 'dir_02', 'other', 0)) v(origin, id, label, aliases)")
def topic_catalog(spark, sf_dir):
    whole, bare = (P.catalog(P.read_taxonomy(spark, _said(spark, json.dumps(x)))) for x in (_TAXONOMY, {**_TAXONOMY, "catalog_topics": []}))
    both = whole.withColumn("origin", F.lit("catalog")).unionByName(bare.withColumn("origin", F.lit("rules")))
    return both.select("origin", "id", "label", F.size("aliases").alias("aliases"))

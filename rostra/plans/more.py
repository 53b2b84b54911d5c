"""Queries of loads, lookups, reprocessing and arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

from rostra.fixtures import SPEECHES_SQL, members, speeches, table
from rostra.functions import text as T
from rostra.operators import state
from rostra.plans import domain as D
from rostra.plans.registry import query


@query("c02_export_load", f"WITH {SPEECHES_SQL} SELECT session_id, speech_index, name, CASE WHEN speech_index % 2 = 0 THEN 'neutral' END AS label FROM speeches JOIN members USING (member_id) WHERE chamber = 'senator'")
def export_load(spark, sf_dir):
    a = speeches(spark, sf_dir).where("speech_index % 2 = 0").select("session_id", "speech_index", F.lit("neutral").alias("label"))
    m = members(spark, sf_dir).where("chamber = 'senator'").select("member_id", "name")
    return speeches(spark, sf_dir).join(m, "member_id").join(a, ["session_id", "speech_index"], "left").select("session_id", "speech_index", "name", "label")


@query("c03_source_filter", f"WITH {D._ANALYSED} SELECT session_id, speech_index, label, name, party_id FROM analysed WHERE label = 'constructive'")
def source_filter(spark, sf_dir):
    return D._analysed(spark, sf_dir).where("label = 'constructive'").select("session_id", "speech_index", "label", "name", "party_id")


@query("c08_point_lookups", f"WITH {SPEECHES_SQL}, w AS (SELECT member_id, count(*) AS n FROM speeches GROUP BY member_id) SELECT m.member_id, m.name, w.n FROM members m JOIN w USING (member_id) WHERE m.member_id IN ('deputat_2', 'senator_3', 'senator_x')")
def point_lookups(spark, sf_dir):
    w = speeches(spark, sf_dir).groupBy("member_id").agg(F.count("*").alias("n"))
    return members(spark, sf_dir).where(F.col("member_id").isin("deputat_2", "senator_3", "senator_x")).join(w, "member_id").select("member_id", "name", "n")


@query("c15_chair_speaks", f"WITH {SPEECHES_SQL} SELECT session_id, speech_index, contains(raw_speaker, '0001') OR contains(raw_speaker, '0017') AS chair FROM speeches")
def chair_speaks(spark, sf_dir):
    from rostra.operators.rules import is_chair

    return speeches(spark, sf_dir).select("session_id", "speech_index", is_chair(F.col("raw_speaker"), F.array(F.lit("0001"), F.lit("0017"))).alias("chair"))


@query("c21_gold_lookup", f"WITH {SPEECHES_SQL}, t AS (SELECT session_id, speech_index * 2 AS speech_index FROM speeches), i AS (SELECT session_id, speech_index, session_id || ':' || speech_index AS intervention_id FROM speeches) SELECT session_id, speech_index, intervention_id, intervention_id IS NOT NULL AS found FROM t LEFT JOIN i USING (session_id, speech_index)")
def gold_lookup(spark, sf_dir):
    s = speeches(spark, sf_dir)
    targets = s.select("session_id", (F.col("speech_index") * 2).alias("speech_index"))
    return state.looked_up(targets, s.withColumn("intervention_id", F.concat_ws(":", "session_id", "speech_index")))


@query("b16_append_history", "SELECT user_id AS run, count(*) AS total, NULL::VARCHAR AS model FROM events WHERE event_id % 2 = 0 GROUP BY user_id UNION ALL SELECT user_id, count(*), 'm' FROM events WHERE event_id % 2 = 1 GROUP BY user_id")
def append_history(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    half = lambda k, name: e.where(F.col("event_id") % 2 == k).groupBy(F.col("user_id").alias(name)).agg(F.count("*").alias("total"))
    return state.append(half(0, "run_no"), half(1, "run").withColumn("model", F.lit("m")), {"run_no": "run"})


@query("b18_cleared", "SELECT doc_id, quality, toxic FROM labels WHERE false")
def cleared(spark, sf_dir):
    return state.cleared(table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


@query("t03_resume", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume(spark, sf_dir):
    done = table(spark, sf_dir, "labels").withColumn("source", F.concat(F.lit("llm_v1:"), F.col("quality")))
    return state.reprocess(table(spark, sf_dir, "documents").select("doc_id"), done, ["doc_id"], F.col("source"))


@query("t04_reprocess_other_model", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def reprocess_other_model(spark, sf_dir):
    done = table(spark, sf_dir, "labels").withColumn("source", F.concat(F.lit("llm_v1:"), F.col("quality")))
    return state.reprocess(table(spark, sf_dir, "documents").select("doc_id"), done, ["doc_id"], F.col("source"), "1")


@query("f29_preview", "SELECT doc_id, CASE WHEN length(t) > 40 THEN left(t, 40) || '…' ELSE t END AS preview FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents)")
def preview(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.capped(T.squeezed(F.col("text")), 40).alias("preview"))


@query("f31_math", "SELECT doc_id, greatest(0, least(1, n_chars / 2000.0::DOUBLE - 0.2))::DOUBLE AS clamped, round(doc_id / nullif(n_chars % 7, 0)::DOUBLE, 2) AS ratio FROM documents")
def math(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.clamped(F.col("n_chars") / 2000.0 - 0.2).alias("clamped"), F.round(F.try_divide(F.col("doc_id"), F.col("n_chars") % 7), 2).alias("ratio"))


@query("s01_index_sort", f"WITH {D._ANALYSED} SELECT member_id, total, row_number() OVER (ORDER BY total DESC, member_id) AS position FROM (SELECT member_id, count(*) AS total FROM analysed WHERE member_id IS NOT NULL GROUP BY member_id)")
def index_sort(spark, sf_dir):
    from pyspark.sql import Window

    c = D._analysed(spark, sf_dir).where("member_id is not null").groupBy("member_id").agg(F.count("*").alias("total"))
    return c.withColumn("position", F.row_number().over(Window.orderBy(F.desc("total"), "member_id")))  # one row a member


@query("s03_topic_sort", "SELECT doc_id, topic, row_number() OVER (PARTITION BY lang ORDER BY starts_with(topic, 'plx ') DESC, n_chars DESC, topic DESC) AS position FROM (SELECT doc_id, lang, n_chars, CASE WHEN doc_id % 5 = 0 THEN 'plx ' || doc_id ELSE source || doc_id END AS topic FROM documents)")
def topic_sort(spark, sf_dir):
    from pyspark.sql import Window

    from rostra.functions.references import law_topic

    d = table(spark, sf_dir, "documents").withColumn("topic", F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("plx "), "doc_id")).otherwise(F.concat("source", "doc_id")))
    w = Window.partitionBy("lang").orderBy(law_topic(F.col("topic")).desc(), F.desc("n_chars"), F.desc("topic"))
    return d.select("doc_id", "topic", F.row_number().over(w).alias("position"))


@query("w09_first_occurrence", "SELECT conv_id, list_filter([CASE WHEN s THEN 'system' END, CASE WHEN u THEN 'user' END, CASE WHEN a THEN 'assistant' END], lambda x: x IS NOT NULL).list_sort() AS roles FROM (SELECT conv_id, bool_or(role = 'system') AS s, bool_or(role = 'user') AS u, bool_or(role = 'assistant') AS a FROM conversations GROUP BY conv_id)")
def first_occurrence(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"])
    return c.groupBy("conv_id").agg(F.array_sort(F.array_distinct(ordered)).alias("roles"))

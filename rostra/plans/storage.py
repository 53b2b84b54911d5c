"""Queries of state, documents, prompts and the boundary to models."""

from __future__ import annotations

from pyspark.sql import functions as F

from rostra.fixtures import SPEECHES_SQL, members, speeches, table
from rostra.operators import chunks, documents, rollups, rules, scoring, sequence, state
from rostra.operators import topics as P
from rostra.plans import domain as D
from rostra.plans.registry import query
from rostra.plans.scalar import FOLD

# State: events in two halves are the old and the new writes.


def _events(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    old, new = e.where("event_id % 2 = 0 and user_id % 3 <> 0"), e.where("event_id % 2 = 1 and user_id % 5 <> 0")
    return state.last_by(old, ["user_id"], "event_id"), state.last_by(new, ["user_id"], "event_id")


_EVENTS = """o AS (SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events WHERE event_id % 2 = 0 AND user_id % 3 <> 0 GROUP BY user_id),
n AS (SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events WHERE event_id % 2 = 1 AND user_id % 5 <> 0 GROUP BY user_id)"""


@query("b01_upsert", f"WITH {_EVENTS} SELECT * FROM n UNION ALL SELECT * FROM o WHERE user_id NOT IN (SELECT user_id FROM n)")
def upsert(spark, sf_dir):
    return state.upsert(*_events(spark, sf_dir), ["user_id"])


@query("b02_conditional_upsert", f"WITH {_EVENTS}, k AS (SELECT user_id FROM o WHERE event_type <> 'click'), w AS (SELECT * FROM n WHERE user_id NOT IN (SELECT user_id FROM k)) SELECT * FROM w UNION ALL SELECT * FROM o WHERE user_id NOT IN (SELECT user_id FROM w)")
def conditional_upsert(spark, sf_dir):
    return state.guarded_upsert(*_events(spark, sf_dir), ["user_id"], "event_type", "click")


@query("b03_accumulate", "SELECT user_id, count(*) AS occurrences, coalesce(max(event_type) FILTER (event_id % 2 = 1), max(event_type)) AS event_type FROM events GROUP BY user_id")
def accumulate(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    count = lambda odd: e.where(F.col("event_id") % 2 == odd).groupBy("user_id").agg(F.count("*").alias("occurrences"), F.max("event_type").alias("event_type"))
    return state.accumulate(count(0), count(1), ["user_id"], "occurrences", "event_type")


@query("b04_insert_new", f"WITH {_EVENTS} SELECT * FROM o UNION ALL SELECT * FROM n WHERE user_id NOT IN (SELECT user_id FROM o)")
def insert_new(spark, sf_dir):
    return state.insert_new(*_events(spark, sf_dir), ["user_id"])


@query("b05_idempotent", f"WITH {_EVENTS}, r AS (SELECT user_id, event_type FROM n) SELECT * FROM r EXCEPT SELECT user_id, event_type FROM o")
def idempotent(spark, sf_dir):
    old, new = (x.select("user_id", "event_type") for x in _events(spark, sf_dir))
    return state.changed_rows(old, new, ["user_id"])


@query("t06_run_states", "SELECT user_id AS run_id, arg_max(event_type, event_id) AS status, min(event_id) AS started_at, max(event_id) AS updated_at FROM events GROUP BY user_id")
def run_states(spark, sf_dir):
    return state.run_states(table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("status"), F.col("event_id").alias("at")))


def _files(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(F.concat_ws("#", "url", "page_id").alias("path"), F.sha2("html", 256).alias("content_hash"), "page_id")


_FILES = "files AS (SELECT url || '#' || page_id AS path, sha256(html) AS content_hash, page_id FROM pages), ledger AS (SELECT path, CASE WHEN page_id % 5 = 0 THEN 'other' ELSE content_hash END AS known FROM files WHERE page_id % 7 <> 0)"


@query("t01_changed_files", f"WITH {_FILES} SELECT path, content_hash, CASE WHEN known IS NULL THEN 'new' ELSE 'changed' END AS reason FROM files LEFT JOIN ledger USING (path) WHERE known IS NULL OR known <> content_hash")
def changed_files(spark, sf_dir):
    f = _files(spark, sf_dir)
    ledger = f.where("page_id % 7 <> 0").select("path", F.when(F.col("page_id") % 5 == 0, "other").otherwise(F.col("content_hash")).alias("content_hash"))
    return state.candidates(f, ledger)


@query("t02_mark_processed", f"WITH {_FILES} SELECT path, content_hash FROM files WHERE page_id % 2 = 0 UNION ALL SELECT path, known FROM ledger WHERE path NOT IN (SELECT path FROM files WHERE page_id % 2 = 0)")
def mark_processed(spark, sf_dir):
    f = _files(spark, sf_dir)
    ledger = f.where("page_id % 7 <> 0").select("path", F.when(F.col("page_id") % 5 == 0, "other").otherwise(F.col("content_hash")).alias("content_hash"))
    return state.upsert(ledger, f.where("page_id % 2 = 0").select("path", "content_hash"), ["path"])


@query("c05_pending_anti", "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)")
def pending(spark, sf_dir):
    return state.pending(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), ["doc_id"], F.col("quality") == 1)


@query("c06_semi_delete", "SELECT doc_id, quality FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def semi_delete(spark, sf_dir):
    return state.without(table(spark, sf_dir, "labels").select("doc_id", "quality"), table(spark, sf_dir, "documents").where("lang = 'en'"), ["doc_id"])


@query("c07_missing", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)")
def missing(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return state.missing(table(spark, sf_dir, "documents"), [table(spark, sf_dir, "labels"), e], "doc_id")


@query("p10_filters", "SELECT doc_id FROM documents WHERE lang IN ('en', 'de') AND source LIKE 'src1%'")
def filters(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(F.col("lang").isin("en", "de") & F.col("source").startswith("src1")).select("doc_id")


@query("p12_session_lookup", "SELECT DISTINCT conv_id FROM conversations WHERE conv_id = 3 LIMIT 1")
def session_lookup(spark, sf_dir):
    return table(spark, sf_dir, "conversations").where("conv_id = 3").select("conv_id").distinct().limit(1)


@query("a12_session_link", "SELECT page_id % 20 AS session_id, arg_max(url, url || page_id) AS source_url, min(url || page_id) AS first_path FROM pages GROUP BY 1")
def session_link(spark, sf_dir):
    from rostra.sources.registry import session_links

    return session_links(table(spark, sf_dir, "pages").select((F.col("page_id") % 20).alias("session_id"), F.col("url").alias("source_url"), F.concat("url", "page_id").alias("path")))


@query("a10_gold_targets", "SELECT conv_id::VARCHAR AS session_id, list_sort(list_distinct(list(turn))) AS indexes FROM conversations WHERE role IN ('user', 'assistant') GROUP BY conv_id")
def gold_targets(spark, sf_dir):
    from rostra.sources.registry import gold_targets

    c = table(spark, sf_dir, "conversations").where("role in ('user', 'assistant')")
    return gold_targets(c.select(F.col("conv_id").cast("string").alias("session_id"), F.col("turn").alias("speech_index")))


@query("d18_counts", "SELECT source, count(DISTINCT lang) AS langs, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY source")
def counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count_distinct("lang").alias("langs"), F.count("*").alias("n"), F.min("doc_id").alias("first"))


@query("u01_set_operations", f"SELECT item_id, list_sort(list_intersect(a, b)) AS both_, list_sort(list_distinct(list_concat(a, b))) AS either_, length(list_filter(a, lambda x: NOT list_contains(b, x))) = 0 AS subset FROM (SELECT item_id, list_distinct(regexp_extract_all({FOLD}, '[a-z]+')[1:8]) AS a, list_distinct(regexp_extract_all({FOLD}, '[a-z]+')[5:14]) AS b FROM benchmark)")
def set_operations(spark, sf_dir):
    from rostra.functions.text import analysis_text

    w = F.regexp_extract_all(analysis_text(F.col("text")), F.lit("([a-z]+)"), F.lit(1))
    b = table(spark, sf_dir, "benchmark").select("item_id", F.slice(w, 1, 8).alias("a"), F.slice(w, 5, 10).alias("b"))
    return b.select("item_id", F.array_sort(F.array_intersect("a", "b")).alias("both_"), F.array_sort(F.array_union("a", "b")).alias("either_"), (F.size(F.array_except("a", "b")) == 0).alias("subset"))


@query("s04_retrieval_sort", "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY role = 'system' DESC, round(length(text) / 100) DESC, 'ch:' || conv_id || ':' || turn) AS position FROM conversations")
def retrieval_sort(spark, sf_dir):
    from pyspark.sql import Window

    name = F.concat(F.lit("ch:"), "conv_id", F.lit(":"), "turn")
    w = Window.partitionBy("conv_id").orderBy((F.col("role") == "system").desc(), F.round(F.length("text") / 100).desc(), name)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.row_number().over(w).alias("position"))


@query("s05_limit", "SELECT doc_id FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25")
def limit(spark, sf_dir):
    return table(spark, sf_dir, "documents").orderBy(F.desc("n_chars"), "doc_id").limit(25).select("doc_id")


# Documents


@query(
    "c04_enriched_view",
    f"WITH {SPEECHES_SQL} SELECT session_id, speech_index, s.member_id, party_id, CASE WHEN speech_index % 2 = 0 THEN 'neutral' END AS label, CASE WHEN session_id::BIGINT % 3 = 0 THEN 'x' END AS topic FROM speeches s LEFT JOIN members USING (member_id)",
)
def enriched_view(spark, sf_dir):
    s = speeches(spark, sf_dir).withColumn("intervention_id", F.concat_ws(":", "session_id", "speech_index"))
    a = s.where("speech_index % 2 = 0").select("intervention_id", F.lit("neutral").alias("label"))
    t = s.where("cast(session_id as bigint) % 3 = 0").select("session_id", F.lit("x").alias("topic")).distinct()
    return documents.enriched(s, a, t, members(spark, sf_dir).select("member_id", "party_id")).select("session_id", "speech_index", "member_id", "party_id", "label", "topic")


def _member_documents(spark, sf_dir):
    return documents.member_documents(D._analysed(spark, sf_dir).where("member_id is not null"), D._member_topics(spark, sf_dir))


@query(
    "b06_member_docs",
    f"""WITH {D._MEMBER_TOPICS}, tt AS (SELECT member_id, string_agg(topic || '=' || count, ';' ORDER BY rank) AS top_topics FROM mt GROUP BY member_id)
SELECT a.member_id, 'interventions_' || a.member_id || '_' || regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g') || '.json' AS file, count(*) AS total, count(*) FILTER (label = 'constructive')::INTEGER AS constructive_count,
  coalesce(list(session_id || ':' || speech_index ORDER BY session_id, speech_index) FILTER (label = 'neutral'), []) AS neutral, any_value(top_topics) AS top_topics
FROM analysed a LEFT JOIN tt USING (member_id) WHERE a.member_id IS NOT NULL GROUP BY a.member_id, name""",
)
def member_docs(spark, sf_dir):
    d = F.col("document")
    top = F.array_join(F.transform(d["top_topics"], lambda t: F.concat(t["topic"], F.lit("="), t["count"])), ";")
    lines = F.transform(d["interventions"]["neutral"], lambda x: F.concat_ws(":", x["session_id"], x["speech_index"]))
    return _member_documents(spark, sf_dir).select("member_id", "file", d["interventions_total"].alias("total"), d["constructive_count"].alias("constructive_count"), lines.alias("neutral"), top.alias("top_topics"))


@query(
    "b07_party_docs",
    f"""WITH {D._M1}, pt AS (SELECT party, list(topic ORDER BY rank) AS top_topics FROM (SELECT party_id AS party, topic, row_number() OVER (PARTITION BY party_id ORDER BY sum(count) DESC, topic) AS rank FROM mt JOIN members USING (member_id) GROUP BY party_id, topic) GROUP BY party)
SELECT party, count(*) AS members_count, sum(total)::BIGINT AS total, sum(constructive_count)::BIGINT AS constructive_count, sum(neutral_count)::BIGINT AS neutral_count, sum(non_constructive_count)::BIGINT AS non_constructive_count, list(member_id ORDER BY total DESC, member_id) AS members, any_value(top_topics) AS top_topics FROM mc LEFT JOIN pt USING (party) GROUP BY party""",
)
def party_docs(spark, sf_dir):
    m = rollups.label_counts(D._analysed(spark, sf_dir).where("member_id is not null"), ["member_id", "party_id"]).withColumnRenamed("party_id", "party")
    return documents.party_documents(m, rollups.party_topics(D._member_topics(spark, sf_dir), members(spark, sf_dir)))


@query("b08_topics_doc", f"WITH {D._PHRASE}, a AS (SELECT {D._TKEY} AS key, trim(topic) AS alias, count(*) AS n FROM phrases WHERE trim(topic) <> '' GROUP BY ALL), c AS (SELECT key, list(alias ORDER BY n DESC, lower(alias), alias)[1] AS canonical, sum(n)::BIGINT AS count, list(alias ORDER BY n DESC, lower(alias), alias)[1:8] AS aliases FROM a GROUP BY key) SELECT canonical, count, aliases FROM c ORDER BY count DESC, canonical, key LIMIT 200")
def topics_doc(spark, sf_dir):
    return documents.topics_document(P.canonical(D._phrases(spark, sf_dir), P.topic_key(F.col("topic"), D.EQUIV, D.STOPS)))


@query("b09_session_docs", f"WITH {D._SESSION_TOPICS}, s AS (SELECT conv_id::VARCHAR AS session_id, min('s' || conv_id || '_' || role) AS stenogram, arg_max('u/' || role, 's' || conv_id || '_' || role) AS source_url FROM conversations GROUP BY conv_id) SELECT s.*, coalesce(t, []) AS topics FROM s LEFT JOIN (SELECT session_id, list(topic ORDER BY rank) AS t FROM topics WHERE rank <= 20 GROUP BY session_id) USING (session_id)")
def session_docs(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("session_id"), F.concat(F.lit("s"), "conv_id", F.lit("_"), "role").alias("path"), F.concat(F.lit("u/"), "role").alias("source_url"))
    t = P.session_topics(speeches(spark, sf_dir), D._notes(spark, sf_dir), D.TAXONOMY)
    return documents.session_documents(c, t)


@query("b11_summary", f"WITH {SPEECHES_SQL} SELECT 'r1' AS run_id, '{{\"run_id\":\"r1\",\"sessions\":' || count(DISTINCT session_id) || ',\"speeches\":' || count(*) || '}}' AS summary FROM speeches")
def summary(spark, sf_dir):
    return documents.summary(speeches(spark, sf_dir).agg(F.count_distinct("session_id").alias("sessions"), F.count("*").alias("speeches")), "r1")


@query("b12_prompt_file", f"WITH {SPEECHES_SQL} SELECT session_id, speech_index, 'interventions_' || session_date::VARCHAR || '_' || session_id || '_t0_m-1_' || regexp_replace(raw_speaker, '[^A-Za-z0-9._-]+', '-', 'g') || '.txt' AS file FROM speeches")
def prompt_file(spark, sf_dir):
    s = speeches(spark, sf_dir)
    return s.select("session_id", "speech_index", documents.prompt_file("interventions", F.col("session_date"), F.col("session_id"), F.lit("t0"), F.lit("m:1"), F.col("raw_speaker")).alias("file"))


@query(
    "x02_prompt",
    f"""WITH {SPEECHES_SQL}, {D.NOTES_SQL}, c AS (SELECT *, string_agg('- [' || raw_speaker || '] ' || text, chr(10)) OVER (PARTITION BY session_id ORDER BY speech_index ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS ctx FROM speeches)
SELECT session_id, speech_index, md5('Session: ' || session_id || chr(10) || 'Speaker: ' || raw_speaker || CASE WHEN trim(initial_notes) <> '' THEN chr(10) || chr(10) || '## Notes' || chr(10) || initial_notes ELSE '' END
  || CASE WHEN ctx IS NOT NULL THEN chr(10) || chr(10) || '## Context' || chr(10) || ctx ELSE '' END || chr(10) || chr(10) || '## Speech' || chr(10) || text) AS prompt FROM c JOIN notes USING (session_id)""",
)
def prompt(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("session_id").orderBy("speech_index").rowsBetween(-3, -1)
    s = speeches(spark, sf_dir).withColumn("context", F.collect_list(F.struct("raw_speaker", "text")).over(w)).join(D._notes(spark, sf_dir), "session_id")
    p = documents.prompt([("Session", F.col("session_id")), ("Speaker", F.col("raw_speaker"))], [("Notes", F.col("initial_notes")), ("Context", documents.context_lines(F.col("context"))), ("Speech", F.col("text"))])
    return s.select("session_id", "speech_index", F.md5(p).alias("prompt"))


# The boundary to models


@query("x03_plan", f"WITH {SPEECHES_SQL} SELECT session_id, sum(least(length(text), 400))::BIGINT AS chars, count(*) AS speeches, CASE WHEN sum(least(length(text), 400)) <= 1200 THEN 'single_pass' ELSE 'map_reduce' END AS mode FROM speeches GROUP BY session_id")
def plan(spark, sf_dir):
    return scoring.plan(speeches(spark, sf_dir), cap=400, single=1200)


@query(
    "f28_topics_payload",
    "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN ['Alfa ' || lang, 'Beta'] ELSE [lang] END AS labels, CASE WHEN doc_id % 2 = 0 THEN [1.0, 0.5] ELSE [0.0] END::DOUBLE[] AS confidence FROM documents",
)
def topics_payload(spark, sf_dir):
    both = F.concat(F.lit('```json\n{"matched_topics": [{"label": " Alfa '), "lang", F.lit(' ", "confidence": 7}, {"label": ""}], "new_topics": [{"label": "Beta", "confidence": 0.5}, {"label": "BETA"}]}\n```'))
    old = F.concat(F.lit('{"topics": [{"label": "'), "lang", F.lit('", "confidence": -1}]}'))
    d = table(spark, sf_dir, "documents").select("doc_id", scoring.topics_payload(F.when(F.col("doc_id") % 2 == 0, both).otherwise(old)).alias("t"))
    return d.select("doc_id", F.col("t.label").alias("labels"), F.col("t.confidence").alias("confidence"))


@query("f23_reasoning", "SELECT doc_id, CASE WHEN n_chars % 3 = 0 THEN 'Discursul este constructiv deoarece include conținut substanțial și orientat spre soluții.' ELSE 'Intervenția este neutră, predominant procedurală sau fără substanță de politică publică.' END || ' Teme: ' || lang || ', ' || source || '. Citat: \"q\".' AS reasoning FROM documents")
def reasoning(spark, sf_dir):
    label = F.when(F.col("n_chars") % 3 == 0, "constructive").otherwise("neutral")
    return table(spark, sf_dir, "documents").select("doc_id", scoring.reasoning(label, F.array("lang", "source", F.lit("z")), F.lit("q")).alias("reasoning"))


@query("f34_model_settings", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'abc:30b' WHEN doc_id % 3 = 1 THEN 'abc:7b-32k' ELSE 'gpt' END AS model, CASE WHEN doc_id % 3 = 0 THEN 8192 WHEN doc_id % 3 = 1 THEN 32768 END AS num_ctx, CASE WHEN doc_id % 3 = 1 THEN 'three_layer' ELSE 'one_pass' END AS architecture, CASE WHEN doc_id % 3 = 0 THEN 6000 ELSE 22000 END AS chunk_chars FROM documents")
def model_settings(spark, sf_dir):
    k = F.col("doc_id") % 3
    m = F.when(k == 0, "abc:30b:latest").when(k == 1, " abc:7b-32k").otherwise("gpt")
    return table(spark, sf_dir, "documents").select("doc_id", scoring.model_settings(m, F.when(k == 2, "openai").otherwise("ollama")).alias("s")).select("doc_id", "s.*")


_FITS = f"length({FOLD.replace('text', 'substr(text, 5, 60)')}) >= 24"


@query(
    "c18_realign",
    f"""WITH {SPEECHES_SQL}, q AS (SELECT session_id, speech_index, speech_index % 3 AS m, {_FITS} AS fits FROM speeches)
SELECT session_id, speech_index, speech_index AS position, CASE WHEN m = 0 THEN 1 WHEN m = 2 THEN 2 WHEN fits THEN 1 ELSE 3 END AS tier FROM q WHERE m < 2 OR fits""",
)
def realign(spark, sf_dir):
    s = speeches(spark, sf_dir)
    items = s.select("session_id", F.col("speech_index").alias("position"), (F.col("speech_index") + F.when(F.col("speech_index") % 3 == 2, 100).otherwise(0)).alias("item_index"), F.when(F.col("speech_index") % 3 == 0, "").otherwise(F.substring("text", 5, 60)).alias("quote"))
    return scoring.realigned(s, items)


_SHORT = f"(({D._BARE}) OR (length(text) < 120 AND NOT {D._BUILT}))"
_WORDS16 = f"regexp_extract_all({FOLD}, '[a-zA-ZăâîșțĂÂÎȘȚ]+')"
_QUOTE = f"CASE WHEN length({_WORDS16}) < 6 THEN '' ELSE trim(left(array_to_string({_WORDS16}[1:16], ' '), 160)) END"


@query(
    "r06_validated",
    f"""WITH {SPEECHES_SQL}, {D._SIGNALS}, q AS (SELECT *, {_SHORT} AS s, {_QUOTE} AS quote, {FOLD} AS k FROM signals), b AS (SELECT *, quote <> '' AND length(quote) >= 24 AND contains(k, quote) AS based FROM q)
SELECT session_id, speech_index, CASE WHEN s THEN 'neutral' ELSE label END AS label, quote AS evidence_quote, NOT based AS needs_recheck,
  CASE WHEN s THEN greatest(confidence, 0.75) WHEN based THEN confidence ELSE least(confidence, 0.6) END::DOUBLE AS confidence FROM b""",
)
def validated(spark, sf_dir):
    s = D._signalled(spark, sf_dir).withColumn("evidence_quote", F.lit("this is nowhere in any of the speeches"))
    return scoring.validated(s, F.length("text") < 120).select("session_id", "speech_index", "label", "evidence_quote", "needs_recheck", "confidence")


@query("x06_embed")
def embed(spark, sf_dir):
    return scoring.embedded(speeches(spark, sf_dir).select("session_id", "speech_index", "text"), F.col("text")).drop("text")


@query("f27_coerce")
def coerce(spark, sf_dir):
    answers = F.when(F.col("doc_id") % 3 == 0, F.lit('```json\n{"data": "{\\"results\\": [{\\"a\\": 1}]}"}\n```')).when(F.col("doc_id") % 3 == 1, F.lit("not json")).otherwise(F.lit('{"speech_index": 1, "final_label": "neutral"}'))
    return scoring.with_results(table(spark, sf_dir, "documents").select("doc_id", answers.alias("answer")), "answer")


@query("b15_quarantine")
def quarantine(spark, sf_dir):
    return scoring.malformed(coerce(spark, sf_dir))


@query("a06_binary_scan")
def binary_scan(spark, sf_dir):
    from rostra.sources.registry import read_files

    return read_files(spark, f"{sf_dir}/*.parquet").drop("modified")


@query("t05_stale_index", f"WITH {D.CHUNKS_SQL}, h AS (SELECT session_id, substr(sha256(string_agg(chunk_id || text, '' ORDER BY chunk_index)), 1, 16) AS content_hash FROM chunks GROUP BY session_id) SELECT session_id, content_hash FROM h WHERE session_id::BIGINT % 2 = 0")
def stale_index(spark, sf_dir):
    h = chunks.index_hash(D._chunks(spark, sf_dir)).select("session_id", "content_hash")
    old = h.withColumn("content_hash", F.when(F.col("session_id").cast("long") % 2 == 0, "old").otherwise(F.col("content_hash")))
    return state.changed_rows(old, h, ["session_id"])


@query("w02_marker_counts", f"WITH {SPEECHES_SQL} SELECT session_id, speech_index, {D._hits(FOLD, D.TIME)} AS time, {D._hits(FOLD, D.FOUL)} AS procedure FROM speeches")
def marker_counts(spark, sf_dir):
    m = sequence.marker_counts(F.col("text"), {"time": D.TIME, "procedure": D.FOUL})
    return speeches(spark, sf_dir).select("session_id", "speech_index", m.alias("m")).select("session_id", "speech_index", F.col("m.time").cast("long").alias("time"), F.col("m.procedure").cast("long").alias("procedure"))

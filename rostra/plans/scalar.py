"""Queries of single-row functions: text forms, counts, ids, references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.fixtures import MEMBERS_SQL, SPEECHES_SQL, members, speeches, table
from rostra.functions import text as T
from rostra.plans.registry import query

#: N2 in DuckDB.
FOLD = "trim(regexp_replace(replace(lower(strip_accents(text)), 'ß', 'ss'), '\\s+', ' ', 'g'))"
STOP = ", ".join(f"'{w}'" for w in T.RETRIEVAL_STOPWORDS)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query("f01_normalize_n2", f"SELECT doc_id, md5({FOLD}) AS n2 FROM documents")
def normalize_n2(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(T.analysis_text(F.col("text"))).alias("n2"))


@query("f01_normalize_n3", "SELECT doc_id, md5(trim(regexp_replace(lower(strip_accents(text)), '\\s+', ' ', 'g'))) AS n3 FROM documents")
def normalize_n3(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(T.export_text(F.col("text"))).alias("n3"))


@query(
    "f01_normalize_others",
    """WITH f AS (SELECT doc_id, replace(lower(strip_accents(text)), 'ß', 'ss') AS c, lower(strip_accents(text)) AS l FROM documents)
SELECT doc_id, md5(trim(c, ' ' || chr(10) || chr(9) || chr(13))) AS n4, md5(trim(regexp_replace(c, '\\s+', ' ', 'g'))) AS n5,
  md5(trim(regexp_replace(regexp_replace(c, '[^a-z0-9\\s/.-]', ' ', 'g'), '\\s+', ' ', 'g'))) AS n6, md5(trim(l, ' ' || chr(10) || chr(9) || chr(13))) AS n7, md5(c) AS n9,
  md5(trim(regexp_replace(c, '[^a-z0-9]+', ' ', 'g'))) AS n10 FROM f""",
)
def normalize_others(spark, sf_dir):
    c = F.col("text")
    return _docs(spark, sf_dir).select(
        "doc_id", F.md5(T.rules_key(c)).alias("n4"), F.md5(T.agent_key(c)).alias("n5"), F.md5(T.topic_words(c)).alias("n6"),
        F.md5(T.overlap_text(c)).alias("n7"), F.md5(T.qa_text(c)).alias("n9"), F.md5(T.evaluation_topic(c)).alias("n10"),
    )


@query(
    "f01_speaker_key",
    f"WITH {SPEECHES_SQL} SELECT session_id, speech_index, lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw_speaker, '\\s+-\\s+.*$', ''), '^\\s*(domnul|doamna)\\s+', '', 'i'), '\\([^)]*\\)', '', 'g'), '\\s+', ' ', 'g'))) AS speaker_key FROM speeches",
)
def speaker_key(spark, sf_dir):
    return speeches(spark, sf_dir).select("session_id", "speech_index", T.speaker_key(F.col("raw_speaker")).alias("speaker_key"))


@query("f02_slug", "SELECT s_suppkey, coalesce(nullif(trim(regexp_replace(lower(strip_accents(s_name)), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown') AS slug FROM supplier")
def slug(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", T.slug(F.col("s_name")).alias("slug"))


@query("f03_retrieval_tokens", f"SELECT doc_id, list_filter(regexp_extract_all({FOLD}, '[a-z0-9]+'), lambda w: length(w) >= 3 AND w NOT IN ({STOP})) AS tokens FROM documents")
def retrieval_tokens(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.retrieval_tokens(F.col("text")).alias("tokens"))


@query(
    "f04_mapped_tokens",
    "SELECT doc_id, list_filter(list_transform(regexp_extract_all(trim(regexp_replace(lower(strip_accents(text)), '\\s+', ' ', 'g')), '[a-z0-9]+'), lambda w: CASE w WHEN 'the' THEN 'article' WHEN 'and' THEN 'an' WHEN 'der' THEN 'article' ELSE w END), lambda w: length(w) >= 3 AND w NOT IN ('with', 'from')) AS tokens FROM documents",
)
def mapped_tokens(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.mapped_tokens(F.col("text"), {"the": "article", "and": "an", "der": "article"}, ["with", "from"]).alias("tokens"))


@query("f05_overlap_tokens", "SELECT doc_id, list_sort(list_distinct(list_filter(regexp_extract_all(lower(strip_accents(text)), '[a-z0-9]+'), lambda w: length(w) >= 4 AND w NOT IN ('with', 'that')))) AS tokens FROM documents")
def overlap_tokens(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.array_sort(T.overlap_tokens(F.col("text"), ["with", "that"])).alias("tokens"))


@query("f06_word_count", "SELECT doc_id, length(regexp_extract_all(text, '[\\p{L}\\p{N}]+(?:[''-][\\p{L}\\p{N}]+)*')) AS words FROM documents")
def word_count(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.word_count(F.col("text")).cast("long").alias("words"))


@query("f07_letter_count", "SELECT doc_id, length(regexp_extract_all(text, '[\\p{L}\\p{Nl}\\p{No}]')) AS letters FROM documents")
def letter_count(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.letter_count(F.col("text")).cast("long").alias("letters"))


@query("f08_plain_words", f"SELECT doc_id, length(regexp_extract_all(text, '[{T.LETTERS_RO}]+')) AS words FROM documents")
def plain_words(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.plain_word_count(F.col("text")).cast("long").alias("words"))


@query("f09_sentences", "SELECT doc_id, length(list_filter(regexp_split_to_array(text, '[.!?]+'), lambda s: trim(s, ' ' || chr(10) || chr(9)) <> '')) AS sentences FROM documents")
def sentences(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.sentence_count(F.col("text")).cast("long").alias("sentences"))


@query("f19_clean_topic", "SELECT item_id, trim(regexp_replace(regexp_replace('3) * ' || split_part(text, '.', 1) || ' ;', '^[-*\\d.)(\\[\\]]+\\s*', ''), '\\s+', ' ', 'g'), ' ,;:.') AS topic, NOT regexp_matches(text, '[a-zA-ZĂÂÎȘȚăâîșț]') AS noise FROM benchmark")
def clean_topic(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark")
    raw = F.concat(F.lit("3) * "), F.split_part("text", F.lit("."), F.lit(1)), F.lit(" ;"))
    return b.select("item_id", T.cleaned_topic(raw).alias("topic"), T.noise_topic(F.col("text")).alias("noise"))


_VARIANTS = ", ".join(f"CASE WHEN suffix(w, '{s}') AND length(w) >= {len(s) + 3} THEN left(w, length(w) - {len(s)}) END" for s in T.SUFFIXES)


@query("f20_token_variants", f"SELECT w AS token, list_sort(list_distinct([w, {_VARIANTS}])) AS variants FROM (SELECT DISTINCT unnest(regexp_extract_all({FOLD}, '[a-z]+')) AS w FROM benchmark)")
def token_variants(spark, sf_dir):
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all(T.analysis_text(F.col("text")), F.lit("([a-z]+)"), F.lit(1))).alias("token")).distinct()
    return words.select("token", F.array_sort(T.variants(F.col("token"))).alias("variants"))


@query(
    "f21_quote_grounded",
    f"""WITH q AS (SELECT conv_id, turn, {FOLD} AS s, '“' || substr(text, 10, 30) || '"' AS quote, trim(regexp_replace(replace(lower(strip_accents(substr(text, 10, 30))), 'ß', 'ss'), '\\s+', ' ', 'g')) AS k FROM conversations)
SELECT conv_id, turn, k <> '' AND length(k) >= 24 AND contains(s, k) AS grounded FROM q""",
)
def quote_grounded(spark, sf_dir):
    quote = F.concat(F.lit("“"), F.substring("text", 10, 30), F.lit('"'))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.quote_grounded(quote, F.col("text")).alias("grounded"))


@query("f22_fallback_quote", f"SELECT conv_id, turn, CASE WHEN length(w) < 6 THEN '' ELSE trim(left(array_to_string(w[1:16], ' '), 160)) END AS quote FROM (SELECT conv_id, turn, regexp_extract_all({FOLD}, '[{T.LETTERS_RO}]+') AS w FROM conversations)")
def fallback_quote(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.fallback_quote(F.col("text")).alias("quote"))


@query("f30_sanitize", "SELECT page_id, regexp_replace(url, '[^A-Za-z0-9._-]+', '-', 'g') AS name FROM pages")
def sanitize(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.safe_name(F.col("url")).alias("name"))


@query("p01_merge_text", "SELECT page_id, array_to_string(list_filter([trim(url), trim('  '), trim(html, ' ' || chr(10) || chr(9))], lambda x: x <> ''), ' ') AS merged FROM pages")
def merge_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.merged_text(F.col("url"), F.lit("  "), F.col("html")).alias("merged"))


@query("p02_ids", f"WITH {SPEECHES_SQL} SELECT session_id, speech_index, 'iv:' || substr(sha1('session_' || session_id || '.json'), 1, 12) || ':' || speech_index AS intervention_id, sha256(text) AS text_hash FROM speeches")
def ids(spark, sf_dir):
    path = F.concat(F.lit("session_"), "session_id", F.lit(".json"))
    return speeches(spark, sf_dir).select("session_id", "speech_index", intervention_id(path, F.col("speech_index")).alias("intervention_id"), F.sha2("text", 256).alias("text_hash"))


def intervention_id(path, index):
    """P2."""
    return F.concat(F.lit("iv:"), F.substring(F.sha1(path), 1, 12), F.lit(":"), index)


@query("p07_cap", "SELECT conv_id, turn, CASE WHEN length(text) > 600 THEN left(text, 600) || '…' ELSE text END AS text FROM conversations")
def cap(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.capped(F.col("text"), 600).alias("text"))


@query("p08_keyword_hits", f"SELECT doc_id, length(list_filter(['tion', 'ing', 'lich', 'ment', 'con la'], lambda k: contains({FOLD}, k))) AS hits FROM documents")
def keyword_hits(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.hits(T.analysis_text(F.col("text")), ["tion", "ing", "lich", "ment", "con la"]).cast("long").alias("hits"))


@query("p04_label_map", "SELECT doc_id, CASE WHEN lang IN ('en', 'fr') THEN lang ELSE 'neutral' END AS label FROM documents")
def label_map(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", known_or(F.col("lang"), ["en", "fr"], "neutral").alias("label"))


def known_or(c, known, default):
    """A value that isn't known is the default."""
    return F.when(c.isin(known), c).otherwise(default)


@query("p05_safe_topics", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN ['a ' || lang] WHEN 1 THEN []::VARCHAR[] WHEN 2 THEN []::VARCHAR[] ELSE ['x', 'y'] END AS topics FROM documents")
def safe_topics_query(spark, sf_dir):
    k = F.col("doc_id") % 4
    raw = F.when(k == 0, F.concat(F.lit('[" a '), "lang", F.lit(' ", 3, ""]'))).when(k == 1, F.lit("{broken")).when(k == 2, F.lit('{"a": 1}')).otherwise(F.lit('["x", {"label": "z"}, " y"]'))
    return _docs(spark, sf_dir).select("doc_id", safe_topics(raw).alias("topics"))


def safe_topics(c):
    """P5: the strings of a JSON list, trimmed, without blank ones; nothing if it isn't a list."""
    typed = F.try_variant_get(F.try_parse_json(c), "$", "array<variant>")
    text = F.transform(typed, lambda v: F.when(F.schema_of_variant(v) == "STRING", T.stripped(F.try_variant_get(v, "$", "string"))))
    return F.coalesce(F.filter(text, lambda x: x.isNotNull() & (x != "")), F.array().cast("array<string>"))


@query("n12_token_key", "SELECT s_suppkey, array_to_string(list_sort(list_filter(string_split(regexp_replace(lower(s_name), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')), ' ') AS token_key FROM supplier")
def name_token_key(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", T.token_key(T.speaker_key(F.col("s_name"))).alias("token_key"))


@query("d20_usage", "SELECT role, count(*) AS calls, sum(greatest(1, round(length(text) / 3.8)))::BIGINT AS tokens FROM conversations GROUP BY role")
def usage(spark, sf_dir):
    return table(spark, sf_dir, "conversations").groupBy("role").agg(F.count("*").alias("calls"), F.sum(T.estimated_tokens(F.col("text"))).alias("tokens"))


@query("a02_source_id", f"WITH {MEMBERS_SQL} SELECT member_id, CASE WHEN number % 3 = 0 THEN number::VARCHAR WHEN number % 3 = 1 AND chamber = 'senator' THEN 'p' || number WHEN number % 3 = 1 THEN 'https://x.example/p?ParlamentarID=p' || number ELSE sha1(name) END AS source_id FROM members")
def source_id_query(spark, sf_dir):
    from rostra.sources.registry import source_id

    k = F.col("number") % 3
    url = F.when(k == 1, F.concat(F.lit("https://x.example/p?ParlamentarID=p"), "number"))
    return members(spark, sf_dir).select("member_id", source_id(F.when(k == 0, F.col("number").cast("string")), url, F.col("chamber"), F.col("name")).alias("source_id"))


@query("a03_first_int", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN doc_id WHEN doc_id % 3 = 1 THEN greatest(0, 50 - doc_id) ELSE 0 END AS bills FROM documents")
def first_int_query(spark, sf_dir):
    from rostra.sources.registry import first_count

    k = F.col("doc_id") % 3
    return _docs(spark, sf_dir).select("doc_id", first_count(F.when(k == 0, F.col("doc_id").cast("string")).otherwise("n/a"), F.when(k == 1, (50 - F.col("doc_id")).cast("string"))).alias("bills"))

"""Queries of the staged classification, topic extraction, state tables and readers, over answers that numbers decide."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from rostra.fixtures import SPEECHES_SQL, speeches, table
from rostra.operators import chunks as C
from rostra.operators import documents, orchestration, rollups, rules, scoring
from rostra.plans import domain as D
from rostra.plans import storage as S
from rostra.plans.registry import ORACLE, query
from rostra.plans.scalar import FOLD
from rostra.sources import tables

_NOWHERE = "this is nowhere in any of the speeches"


def _parts(prompt: str) -> tuple[int, str]:
    """Session and index, summed, and the speech."""
    session, index = re.search(r"Session: (\d+)\nIndex: (\d+)", prompt).groups()
    return int(session) + int(index), prompt.split("## Speech\n", 1)[1]


def _signals_of(h: int, n: int) -> dict:
    out = {x: ("yes", "partial", "no")[(h * (k + 2) + n * (k + 1)) % 3] for k, x in enumerate(rules.SIGNALS)}
    return out | {"argumentation_quality": rules.ARGUMENTATION[n % 3], "primary_function": rules.FUNCTIONS[n % 6], "evidence_quote": _NOWHERE}


def _decision_of(h: int, n: int) -> dict:
    return {"constructiveness_label": rules.LABELS[(n + h) % 3], "confidence": (n % 101) / 100, "topics": ["x"] if n % 2 == 0 else [], "evidence_quote": _NOWHERE}


def _scorer(answer):
    return lambda: lambda prompts: ["not to be mended" if p.startswith(scoring.MEND) else answer(*_parts(p), p) for p in prompts]


def _signal_answer(h, text, prompt):
    return "no signals" if len(text) % 11 == 0 else "```json\n" + json.dumps(_signals_of(h, len(text))) + "\n```"


def _decision_answer(h, text, prompt):
    return json.dumps(_decision_of(h, len(text)))


def _review_answer(h, text, prompt):
    return json.dumps({"final_label": rules.LABELS[(len(text) + 1) % 3], "final_confidence": 0.8, "qa_action": "confirmed" if len(text) % 2 else "revised_label"})


def _one_answer(h, text, prompt):
    n, index = len(text), int(re.search(r"Index: (\d+)", prompt)[1])
    one = {"speech_index": index, **_signals_of(h, n), **_decision_of(h, n)}
    if "## Again" in prompt:
        return json.dumps({"results": [one | {"constructiveness_label": "neutral", "confidence": 0.9, "topics": []}]})
    if n % 5 == 0:
        return '{"results": []}'
    if n % 5 == 1:
        return json.dumps({"results": [one | {"speech_index": index + 1000, "evidence_quote": ""}]})
    if n % 5 == 2:
        return json.dumps([one | {"constructiveness_label": "maybe"}])
    return json.dumps({"data": {"results": [one | {"speech_index": index + 7, "evidence_quote": ""}, one]}})


_LEXICON = {"greetings": ["the", "tion"], "votes": ["ingly", "thing", "blest"], "replies": ["da"]}
_TOPICS = ["a Thing", "mente, ción"]


def _cases(spark, sf_dir):
    return speeches(spark, sf_dir).withColumns({
        "interruption": F.when(F.col("speech_index") % 5 == 4, "procedure_violation"), "chairs": F.when(F.col("role") == "system", F.array("raw_speaker")).otherwise(F.array().cast("array<string>")),
        "session_topics": F.array(*map(F.lit, _TOPICS)),
    })


_SHORTCUT = re.search(r"SELECT session_id, speech_index, (CASE WHEN speech_index % 5 = 4.*END) AS reason FROM", ORACLE["r02_shortcuts"], re.S)[1]
_QA = re.search(r"(list_filter\(\[.*lambda x: x IS NOT NULL\)) AS reasons", ORACLE["r04_qa"], re.S)[1].replace(f"CASE WHEN {D._N} <= 25", f"CASE WHEN length(candidates) = 0 AND {D._N} <= 25")
_RULES = re.search(r"SELECT session_id, speech_index, (CASE.*AS candidates) FROM signals", ORACLE["r03_rules"], re.S)[1].replace("AS label,", "AS rule_label,").replace("AS confidence,", "AS rule_confidence,")
_GUIDED = re.search(r"t AS \(SELECT \*, (CASE WHEN partisan.*?END) AS target", ORACLE["r05_guidance"], re.S)[1]
_LEAST = re.search(r"AS changed, (CASE target.*?END::DOUBLE) AS least", ORACLE["r05_guidance"], re.S)[1]

_THREE = f"""WITH {SPEECHES_SQL}, {D._SIGNALS},
s1 AS (SELECT *, {_SHORTCUT} AS short, {_RULES}, {S._SHORT} AS bare, {S._QUOTE} AS quote, {FOLD} AS k FROM signals),
s2 AS (SELECT * REPLACE (CASE WHEN short IS NULL THEN candidates ELSE ['neutral'] END AS candidates), short IS NULL AND length(text) % 11 = 0 AS bad, CASE WHEN short IS NOT NULL THEN 'shortcut' WHEN rule_label IS NOT NULL THEN 'rules' ELSE 'decision' END AS st,
  short IS NOT NULL OR bare AS s, quote <> '' AND length(quote) >= 24 AND contains(k, quote) AS based FROM s1),
s3 AS (SELECT *, CASE WHEN bad OR st <> 'decision' THEN []::VARCHAR[] ELSE list_concat({_QA}, CASE WHEN length(candidates) > 0 AND NOT list_contains(candidates, label) THEN ['deterministic_candidate_disagreement'] ELSE []::VARCHAR[] END) END AS qa FROM s2),
s4 AS (SELECT * REPLACE (CASE WHEN length(qa) > 0 THEN {D._list(rules.LABELS)}[(length(text) + 1) % 3 + 1] ELSE label END AS label, CASE WHEN length(qa) > 0 THEN 0.8 ELSE confidence END AS confidence, CASE WHEN length(qa) > 0 THEN 'review' ELSE st END AS st) FROM s3),
s5 AS (SELECT *, {_GUIDED} AS target FROM s4), s6 AS (SELECT *, coalesce(target <> label, false) AS changed, {_LEAST} AS least FROM s5),
s7 AS (SELECT *, CASE st WHEN 'shortcut' THEN 'neutral' WHEN 'rules' THEN rule_label ELSE CASE WHEN changed THEN target ELSE label END END AS l, CASE st WHEN 'shortcut' THEN 0.95 WHEN 'rules' THEN rule_confidence ELSE CASE WHEN changed THEN greatest(confidence, least) ELSE confidence END END::DOUBLE AS c FROM s6),
three AS (SELECT session_id, speech_index, CASE WHEN NOT bad THEN CASE WHEN s THEN 'neutral' ELSE l END END AS label, CASE WHEN NOT bad THEN CASE WHEN s THEN greatest(c, 0.75) WHEN based THEN c ELSE least(c, 0.6) END END::DOUBLE AS confidence,
  CASE WHEN NOT bad THEN CASE WHEN st IN ('decision', 'review') THEN topics ELSE []::VARCHAR[] END END AS topics, CASE WHEN NOT bad THEN quote END AS evidence_quote,
  CASE WHEN NOT bad THEN CASE WHEN st IN ('decision', 'review') AND changed THEN 'revised_label' WHEN st = 'review' THEN CASE WHEN length(text) % 2 = 1 THEN 'confirmed' ELSE 'revised_label' END ELSE 'confirmed' END END AS qa_action,
  CASE WHEN NOT bad THEN qa END AS qa_reasons, CASE WHEN NOT bad THEN NOT based END AS needs_recheck, CASE WHEN NOT bad THEN st END AS source, CASE WHEN bad THEN 'signals' END AS failed FROM s7)"""


def _three(cases):
    return orchestration.three_layer(cases, _scorer(_signal_answer), _scorer(_decision_answer), _scorer(_review_answer), _LEXICON, F.length("text") < 120)


@query("r09_three_layer", f"{_THREE} SELECT * FROM three")
def three_layer(spark, sf_dir):
    return _three(_cases(spark, sf_dir))


@query(
    "r10_one_pass",
    f"""WITH {SPEECHES_SQL}, {D._SIGNALS}, q AS (SELECT *, {_SHORTCUT} AS short, {S._SHORT} AS s, {S._QUOTE} AS quote, {FOLD} AS k, length(text) % 5 AS m FROM signals),
b AS (SELECT *, quote <> '' AND length(quote) >= 24 AND contains(k, quote) AS based FROM q),
f AS (SELECT *, CASE WHEN short IS NOT NULL THEN 'shortcut' WHEN m = 1 THEN 'recheck' WHEN m IN (3, 4) THEN CASE WHEN based THEN 'model' ELSE 'recheck' END END AS source, CASE WHEN short IS NULL THEN CASE m WHEN 0 THEN 'empty' WHEN 2 THEN 'invalid' END END AS failed FROM b)
SELECT session_id, speech_index, CASE source WHEN 'shortcut' THEN 'neutral' WHEN 'recheck' THEN 'neutral' WHEN 'model' THEN CASE WHEN s THEN 'neutral' ELSE label END END AS label,
  CASE source WHEN 'shortcut' THEN 0.95 WHEN 'recheck' THEN CASE WHEN s OR based THEN 0.9 ELSE 0.6 END WHEN 'model' THEN CASE WHEN s THEN greatest(confidence, 0.75) ELSE confidence END END::DOUBLE AS confidence,
  CASE source WHEN 'model' THEN topics WHEN 'recheck' THEN []::VARCHAR[] WHEN 'shortcut' THEN []::VARCHAR[] END AS topics, CASE source WHEN 'shortcut' THEN '' WHEN 'recheck' THEN quote WHEN 'model' THEN quote END AS evidence_quote, source, failed FROM f""",
)
def one_pass(spark, sf_dir):
    return orchestration.one_pass(_cases(spark, sf_dir), _scorer(_one_answer), _LEXICON, F.length("text") < 120)


@query("r11_classify", f"{_THREE} SELECT session_id, speech_index, label, confidence, topics, evidence_quote, source, failed, 'three_layer' AS architecture FROM three WHERE speech_index % 3 <> 0")
def classify(spark, sf_dir):
    cases = _cases(spark, sf_dir)
    ask = {"signals": _scorer(_signal_answer), "decide": _scorer(_decision_answer), "review": _scorer(_review_answer)}
    return orchestration.classify(cases, cases.where("speech_index % 3 = 0"), "abc:7b", "ollama", ask, shortcuts=_LEXICON, procedural=F.length("text") < 120)


_MARKERS = ["tion", "mente", "keit", "eau", "ing"]


def _topic_scorer():
    def answer(prompt: str) -> str:
        met = [m for m in _MARKERS if m in prompt]
        if prompt.startswith("DESCRIBE"):
            return ", ".join(met) or "-"
        return json.dumps({"topics": [{"label": m, "law_id": "L1" if m == "tion" else "L2", "confidence": 0.5} for m in met]})

    return lambda prompts: [answer(p) for p in prompts]


_MET = ", ".join(f"CASE WHEN bool_or(contains(left(text, 400), '{m}')) THEN '{m}' END" for m in _MARKERS)
_EXTRACTED = f"""WITH {SPEECHES_SQL}, p AS (SELECT session_id, sum(least(length(text), 401)) AS chars, list_filter([{_MET}], lambda m: m IS NOT NULL) AS topics FROM speeches GROUP BY session_id),
extracted AS (SELECT session_id, CASE WHEN chars <= 1200 THEN 'single_pass' ELSE 'map_reduce' END AS mode, topics, length(topics) = 0 AS failed FROM p)"""
_SMALL = {"cap": 400, "single": 1200, "window": 700, "batch": 40}


def _pieces(spark, sf_dir):
    return speeches(spark, sf_dir).select("session_id", F.col("speech_index").alias("chunk_index"), "text")


@query("x03_extract_topics", f"{_EXTRACTED} SELECT * FROM extracted")
def extract_topics(spark, sf_dir):
    return orchestration.extract_topics(_pieces(spark, sf_dir), _topic_scorer, **_SMALL).withColumn("topics", F.col("topics.label"))


@query("x04_session_topics", f"{_EXTRACTED} SELECT session_id, topics, list_transform(topics, lambda m: CASE WHEN m = 'tion' THEN 'L1' END) AS laws, 'llm_v1:abc' AS topics_source, mode, failed FROM extracted WHERE session_id::BIGINT % 4 <> 0")
def session_topics(spark, sf_dir):
    pieces = _pieces(spark, sf_dir)
    allowed = pieces.select("session_id", F.array(F.lit("L1")).alias("allowed_laws")).distinct()
    out = orchestration.run_session_topics(pieces, pieces.where("cast(session_id as long) % 4 = 0"), _topic_scorer, "abc", allowed, **_SMALL)
    return out.select("session_id", F.col("topics.label").alias("topics"), F.col("topics.law_id").alias("laws"), "topics_source", "mode", "failed")


# State tables and dates


@query("a14_state_scan", "SELECT doc_id::VARCHAR AS intervention_id, NULL::VARCHAR AS run_id, CASE WHEN doc_id % 2 = 0 THEN lang END AS relevance_label, 'constructiveness_baseline_v1' AS relevance_source, NULL::VARCHAR AS topics_json, NULL::VARCHAR AS layer_a_json, n_chars::DOUBLE AS confidence, NULL::VARCHAR AS evidence_chunk_ids_json, 'scaffold_v1' AS analysis_version, source AS reasoning, NULL::VARCHAR AS created_at, NULL::VARCHAR AS updated_at FROM documents")
def state_scan(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    old = d.select(F.col("doc_id").alias("intervention_id"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("relevance_label"), F.col("n_chars").alias("confidence"), F.col("source").alias("reasoning"), "text")
    return tables.migrated(old, "intervention_analysis")


@query("f32_dates", "SELECT event_id, (CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END)::DATE AS day FROM events")
def dates(spark, sf_dir):
    said = F.when(F.col("event_id") % 3 == 0, "no day").when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, sf_dir, "events").select("event_id", tables.dates(F.concat(F.lit(" "), said)).alias("day"))


@query("b10_productivity_docs", f"WITH {D._D9} SELECT level, CASE level WHEN 'member' THEN 'productivity_members/' || member_id || '.json' WHEN 'party' THEN 'productivity_parties/' || lower(regexp_replace(party_id, '[^A-Za-z0-9]+', '-', 'g')) || '.json' ELSE 'productivity_total.json' END AS file, interventions, letter_productivity_pct FROM productivity")
def productivity_docs(spark, sf_dir):
    d = documents.productivity_documents(rollups.productivity(D._analysed(spark, sf_dir)))
    return d.select("level", "file", "document.interventions", "document.letter_productivity_pct")


@query("x07_inspect", f"WITH h AS ({ORACLE['c13_hybrid']}), c AS (WITH {D.CHUNKS_SQL} SELECT session_id, chunk_id, chunk_type, text FROM chunks) SELECT h.session_id, speech_index, position, chunk_id, reason, score, chunk_type, length(text) AS chars, CASE WHEN length(text) > 80 THEN left(text, 80) || '…' ELSE text END AS preview FROM h JOIN c USING (session_id, chunk_id)")
def inspect(spark, sf_dir):
    return C.inspected(C.hybrid(speeches(spark, sf_dir), D._chunks(spark, sf_dir)), D._chunks(spark, sf_dir), 80)

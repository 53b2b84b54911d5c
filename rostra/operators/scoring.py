"""The boundary to models: scorers run by partition, their answers are parsed, aligned and validated.

A scorer is a function from a list of prompts to a list of answers; the default one is a rule and needs no
network. Embedders and scorers are made once a partition by a factory, so clients aren't shipped.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostra.functions.text import clamped, estimated_tokens, fallback_quote, or_empty, quote_grounded, retrieval_tokens, stripped

Scorer = Callable[[list[str]], list[str]]


def rule_scorer() -> Scorer:
    """Answers by length alone: a stand-in with the answers' shape."""

    def score(prompts: list[str]) -> list[str]:
        return [json.dumps({"results": [{"constructiveness_label": "neutral" if len(p) < 400 else "constructive", "confidence": round(min(1.0, len(p) / 2000), 3), "topics": []}]}) for p in prompts]

    return score


#: Put before an answer that can't be read, to have it mended.
MEND = "Repair this malformed output into valid JSON of the same content. Output JSON only.\n\n"


def asked(scorer: Scorer, prompts: list[str], retries: int = 3, pause: float = 0.0) -> list[str | None]:
    """An answer for each prompt. What fails together is asked one by one, each `retries` times; null after that."""
    try:
        answers = list(scorer(prompts))
        if len(answers) == len(prompts):
            return answers
    except (OSError, ValueError):
        pass
    if len(prompts) > 1:
        return [x for p in prompts for x in asked(scorer, [p], retries, pause)]
    if retries <= 1:
        return [None]
    time.sleep(pause)
    return asked(scorer, prompts, retries - 1, pause)


def scored(rows: DataFrame, prompt: str, factory: Callable[[], Scorer] = rule_scorer, retries: int = 3, into: str = "answer", pause: float = 0.0, readable: Callable[[str], bool] | None = None) -> DataFrame:
    """Rows and the scorer's answer; null prompts aren't asked, and prompts that fail are null.

    An answer that isn't `readable` is mended by one more question, and stays as it is if that doesn't help.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField(into, T.StringType())])
    place = rows.columns.index(prompt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = factory()
        for batch in batches:
            prompts = batch.column(place).to_pylist()
            at = [i for i, p in enumerate(prompts) if p is not None]
            answers: list = [None] * len(prompts)
            for i, x in zip(at, asked(scorer, [prompts[i] for i in at], retries, pause) if at else []):
                answers[i] = x
            if readable is not None:
                bad = [i for i in at if answers[i] is not None and answers[i].strip() and not readable(answers[i])]
                for i, x in zip(bad, asked(scorer, [MEND + answers[i] for i in bad], 1, pause) if bad else []):
                    answers[i] = x if x is not None and readable(x) else answers[i]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(answers, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def hash_embedding(text: str, size: int = 64) -> list[float]:
    """Token hashes as signed counts, of length 1."""
    v = np.zeros(size)
    for t in text.split():
        h = int.from_bytes(hashlib.blake2b(t.encode(), digest_size=8).digest(), "little")
        v[h % size] += 1 if h >> 63 else -1
    n = float(np.linalg.norm(v))
    return (v / n if n else v).tolist()


def embedded(rows: DataFrame, text: Column, embed: Callable[[str], list[float]] = hash_embedding, into: str = "embedding") -> DataFrame:
    """Rows with the embedding of a text."""

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(embed)

    return rows.withColumn(into, run(F.array_join(retrieval_tokens(text), " ")))


def plan(sessions: DataFrame, text: str = "text", cap: int = 4000, single: int = 82_000) -> DataFrame:
    """For each session whether its texts, each capped, go in one call or by parts."""
    return sessions.groupBy("session_id").agg(F.sum(F.least(F.length(text), F.lit(cap))).alias("chars"), F.count("*").alias("speeches")).withColumn("mode", F.when(F.col("chars") <= single, "single_pass").otherwise("map_reduce"))


def usage(rows: DataFrame, prompt: str, answer: str) -> DataFrame:
    """Calls and estimated tokens."""
    return rows.agg(F.count("*").alias("calls"), F.sum(estimated_tokens(F.col(prompt))).alias("prompt_tokens"), F.sum(estimated_tokens(or_empty(F.col(answer)))).alias("answer_tokens"))


# The keys under which models wrap their results, and those that mark one result.
WRAPPERS = ["results", "speeches", "items", "data", "output", "result"]
MARKERS = {"constructiveness_label", "policy_proposal", "policy_analysis", "public_interest_orientation", "partisan_rhetoric", "legislative_engagement", "procedural_content", "argumentation_quality", "final_label", "final_confidence", "qa_action"}


def unwrapped(answer: str | None) -> str | None:
    """the list of results in a model's answer as JSON, without code fences and wrappers; null if there is none."""
    if answer is None:
        return None
    try:
        found = _results(json.loads("\n".join(x for x in answer.strip().splitlines() if not x.startswith("```"))), 8)
    except ValueError:
        found = None
    return None if found is None else json.dumps(found, ensure_ascii=False)


def _results(value, deep: int):
    if isinstance(value, list):
        return value
    if not isinstance(value, dict) or not deep:
        return None
    single = lambda x: "speech_index" in x and bool(MARKERS & x.keys())
    for inner in (value[k] for k in WRAPPERS if k in value):
        if isinstance(inner, list):
            return inner
        if isinstance(inner, dict):
            if single(inner):
                return [inner]
            if isinstance(inner.get("results"), list):
                return inner["results"]
        if isinstance(inner, str) and inner.strip()[:1] in ("{", "["):
            try:
                return _results(json.loads(inner), deep - 1)
            except ValueError:
                continue
    return [value] if single(value) else None


def with_results(rows: DataFrame, answer: str, into: str = "results") -> DataFrame:
    """F27 as a column; what has no results is kept apart by malformed()."""
    @F.pandas_udf("string")
    def run(answers: pd.Series) -> pd.Series:
        return answers.map(unwrapped)

    return rows.withColumn(into, run(F.col(answer)))


def malformed(rows: DataFrame, results: str = "results") -> DataFrame:
    """The rows whose answer had no results, for a folder of their own."""
    return rows.where(F.col(results).isNull())


_TOPIC = "array<struct<catalog_topic_id:string,label:string,description:string,law_id:string,confidence:double,reason_no_match:string>>"


def topics_payload(answer: Column, label: int = 120, describe: int = 200, most: int = 20) -> Column:
    """matched topics (or those of the older form), then new ones: cut to length, each once but for case, `most` at most."""
    body = F.regexp_replace(F.regexp_replace(stripped(or_empty(answer)), r"^```[a-z]*\s*|\s*```$", ""), r"^﻿", "")
    p = F.from_json(body, f"matched_topics {_TOPIC}, new_topics {_TOPIC}, topics {_TOPIC}")
    old = p["matched_topics"].isNull() & p["new_topics"].isNull()
    none = F.array().cast(_TOPIC)

    def shaped(items, is_new):
        return F.transform(F.coalesce(items, none), lambda t: F.struct(
            (F.lit(None).cast("string") if is_new else F.nullif(F.trim(t["catalog_topic_id"]), F.lit(""))).alias("catalog_topic_id"), F.left(F.trim(F.coalesce(t["label"], F.lit(""))), F.lit(label)).alias("label"),
            F.left(F.trim(F.coalesce(t["description"], F.lit(""))), F.lit(describe)).alias("description"), F.nullif(t["law_id"], F.lit("")).alias("law_id"), clamped(F.coalesce(t["confidence"], F.lit(0.0))).alias("confidence"), F.lit(is_new).alias("is_new_topic")))

    both = F.filter(F.concat(shaped(F.when(old, p["topics"]).otherwise(p["matched_topics"]), False), shaped(p["new_topics"], True)), lambda t: t["label"] != "")
    names = F.transform(both, lambda t: F.lower(t["label"]))
    return F.slice(F.filter(both, lambda t, i: F.array_position(names, F.lower(t["label"])) == i + 1), 1, most)


def realigned(speeches: DataFrame, items: DataFrame) -> DataFrame:
    """For each speech the item meant for it: same index and a quote that fits or none, else a fitting quote, else the index.

    speeches: session_id, speech_index, text; items: session_id, position, item_index, quote. Of several the
    first by position; an item that fits a speech by index and quote isn't given to another.
    """
    j = speeches.join(items, "session_id")
    same, blank = F.col("item_index") == F.col("speech_index"), F.trim(or_empty(F.col("quote"))) == ""
    fits = quote_grounded(F.col("quote"), F.col("text"))
    tier = F.when(same & (blank | fits), 1).when(fits & ~blank, 2).when(same, 3)
    j = j.withColumn("tier", tier).where("tier is not null")
    own = Window.partitionBy("session_id", "position")
    j = j.withColumn("best", F.min("tier").over(own)).where("tier = best or best > 1")
    order = Window.partitionBy("session_id", "speech_index").orderBy("tier", "position")
    return j.withColumn("n", F.row_number().over(order)).where("n = 1").select("session_id", "speech_index", "position", "tier")


def validated(rows: DataFrame, procedural: Column) -> DataFrame:
    """Results with label, confidence and quote made consistent with the speech.

    rows: text, label, confidence, evidence_quote and the signals. A procedural line, or signals of nothing
    else, makes the label neutral with 0.75 at least; a quote that isn't in the speech is replaced by its
    first words; without any, confidence is 0.6 at most and the row needs another look.
    """
    yes = lambda *n: F.exists(F.array(*map(F.col, n)), lambda x: x == "yes")
    no = lambda *n: F.forall(F.array(*map(F.col, n)), lambda x: x == "no")
    work = ("policy_proposal", "policy_analysis", "legislative_engagement")
    short = ((F.col("procedural_content") == "yes") & no(*work)) | (procedural & ~yes(*work))
    given = quote_grounded(F.col("evidence_quote"), F.col("text"))
    quote = F.when(given, F.regexp_replace(stripped(or_empty(F.col("evidence_quote"))), '^["“”]+|["“”]+$', "")).otherwise(fallback_quote(F.col("text")))
    r = rows.withColumn("_short", short).withColumn("evidence_quote", quote).withColumn("_based", quote_grounded(F.col("evidence_quote"), F.col("text")))
    sure = F.when(F.col("_short"), F.greatest(clamped(F.col("confidence")), F.lit(0.75))).otherwise(clamped(F.col("confidence")))
    return (
        r.withColumn("label", F.when(F.col("_short"), "neutral").otherwise(F.col("label"))).withColumn("procedural_content", F.when(procedural & F.col("_short"), "yes").otherwise(F.col("procedural_content")))
        .withColumn("confidence", F.when(F.col("_based") | F.col("_short"), sure).otherwise(F.least(sure, F.lit(0.6)))).withColumn("needs_recheck", ~F.col("_based")).drop("_short", "_based")
    )


# How a label is explained, and words that show an explanation is in English.
REASONS = {
    "constructive": "Discursul este constructiv deoarece include conținut substanțial și orientat spre soluții.",
    "neutral": "Intervenția este neutră, predominant procedurală sau fără substanță de politică publică.",
    "non_constructive": "Discursul este non-constructiv deoarece domină atacul retoric sau blocarea dezbaterii.",
}


def reasoning(label: Column, topics: Column, quote: Column) -> Column:
    """an explanation from label, the first two topics and the quote."""
    base = F.when(label == "constructive", REASONS["constructive"]).when(label == "neutral", REASONS["neutral"]).otherwise(REASONS["non_constructive"])
    about = F.when(F.size(topics) > 0, F.concat(F.lit(" Teme: "), F.array_join(F.slice(topics, 1, 2), ", "), F.lit("."))).otherwise("")
    return F.concat(base, about, F.when(or_empty(quote) != "", F.concat(F.lit(' Citat: "'), quote, F.lit('".'))).otherwise(""))


def shares_words(a: Column, b: Column, least: int = 2) -> Column:
    """two content words in common."""
    return F.size(F.array_intersect(F.array_distinct(retrieval_tokens(a)), F.array_distinct(retrieval_tokens(b)))) >= least


_CONTEXT, _SIZE = r"(?i)(?<!\d)(\d{1,3})k(?![a-z0-9])", r"(?i)(?<!\d)(\d+(?:\.\d+)?)b(?![a-z0-9])"


def model_settings(model: Column, provider: Column, context: int = 8192, large: int = 32_768, chars: tuple[int, int] = (22_000, 6_000)) -> Column:
    """context, architecture and chunk size that a model's name implies."""
    name = F.regexp_replace(F.trim(or_empty(model)), ":latest$", "")
    k, b = F.regexp_extract(name, _CONTEXT, 1), F.regexp_extract(name, _SIZE, 1)
    local = F.lower(F.trim(provider)) == "ollama"
    window = F.when(local, F.when(k != "", k.try_cast("int") * 1024).otherwise(context))
    return F.struct(
        name.alias("model"), window.alias("num_ctx"), F.when(~local | (F.coalesce(b.try_cast("double"), F.lit(0.0)) >= 27), "one_pass").otherwise("three_layer").alias("architecture"),
        F.when(~local | (window >= large), chars[0]).otherwise(chars[1]).alias("chunk_chars"),
    )

"""Classification of speeches and extraction of topics, stage by stage.

A stage is a column: a row that a rule has settled has a null prompt from there on, so that a model sees each row
that needs it once, and no branch of a plan asks it again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostra.functions.text import clamped, or_empty, quote_grounded, stripped
from rostra.operators import rules, scoring, state
from rostra.operators.documents import prompt
from rostra.operators.scoring import Scorer

Factory = Callable[[], Scorer]
_SIGNALS = [*rules.SIGNALS, "argumentation_quality", "primary_function"]
_CHOICES = {**{n: ["yes", "partial", "no"] for n in rules.SIGNALS}, "argumentation_quality": rules.ARGUMENTATION, "primary_function": rules.FUNCTIONS}
_NO_TEXTS = "array<string>"


def is_json(answer: str) -> bool:
    try:
        json.loads("\n".join(x for x in answer.strip().splitlines() if not x.startswith("```")))
    except ValueError:
        return False
    return True


def _object(answer: str, shape: str) -> Column:
    """A model's answer, without code fences, as a struct; null fields where it can't be read."""
    return F.from_json(F.regexp_replace(stripped(or_empty(F.col(answer))), r"^```[a-z]*\s*|\s*```$", ""), shape)


def _question(*sections: tuple[str, Column]) -> Column:
    return prompt([("Session", F.col("session_id")), ("Index", F.col("speech_index").cast("string")), ("Speaker", F.col("raw_speaker"))], [*sections, ("Speech", F.col("text"))])


def _ask(rows: DataFrame, when: Column, question: Column, factory: Factory, into: str, **how) -> DataFrame:
    return scoring.scored(rows.withColumn("_ask", F.when(when, question)), "_ask", factory, into=into, readable=is_json, **how).drop("_ask")


def three_layer(speeches: DataFrame, signals: Factory, decide: Factory, review: Factory, shortcuts: dict | None = None, procedural: Column | None = None, most: int = 3, **how) -> DataFrame:
    """session_id, speech_index, label, confidence, topics, evidence_quote, qa_action, qa_reasons, needs_recheck, source, failed.

    speeches: session_id, speech_index, raw_speaker, text, interruption, chairs, session_topics. Shortcuts settle
    trivial speeches (R2). Else the model gives signals (A); rules settle some of those (R3); for the rest it
    decides (B), and reviews (C) what looks doubtful (R4) or is no candidate of the rules. Guidance (R5) can
    change what was decided, and all results are made consistent with the speech (R6). `source` tells which stage
    decided, `failed` which gave an answer that isn't valid; such rows have no label.
    """
    chair = rules.is_chair(F.col("raw_speaker"), F.col("chairs"))
    r = speeches.withColumn("_shortcut", rules.shortcut(F.col("text"), F.col("interruption"), **(shortcuts or {})))
    open_ = F.col("_shortcut").isNull()

    r = _ask(r, open_, _question(), signals, "_a", **how)
    shape = ", ".join(f"{n} string" for n in (*_SIGNALS, "evidence_quote"))
    r = r.withColumn("_s", _object("_a", shape))
    for n in _SIGNALS:
        settled = "yes" if n == "procedural_content" else "none" if n == "argumentation_quality" else "procedural" if n == "primary_function" else "no"
        r = r.withColumn(n, F.when(open_, F.lower(F.trim(F.col(f"_s.{n}")))).otherwise(settled))
    r = r.withColumn("failed", F.when(open_ & (F.size(rules.choice_errors(_CHOICES)) > 0), "signals"))
    r = r.withColumn("_r", rules.after_signals(F.col("text"), chair))
    open_ = open_ & F.col("failed").isNull() & F.col("_r.label").isNull()

    r = _ask(r, open_, _question(("Signals", F.col("_a"))), decide, "_b", **how)
    b = _object("_b", "constructiveness_label string, confidence double, topics array<string>, evidence_quote string")
    r = r.withColumn("_d", b).withColumn("label", F.lower(F.trim("_d.constructiveness_label"))).withColumn("confidence", F.col("_d.confidence"))
    r = r.withColumn("topics", F.coalesce(rules.clean_topics(F.col("_d.topics"), most), F.array().cast(_NO_TEXTS)))
    r = r.withColumn("failed", F.when(open_ & (F.size(rules.choice_errors({"label": rules.LABELS}, "confidence")) > 0), "decision").otherwise(F.col("failed")))
    open_ = open_ & F.col("failed").isNull()

    candidates = F.col("_r.candidates")
    foreign = F.array_compact(F.array(F.when((F.size(candidates) > 0) & ~F.array_contains(candidates, F.col("label")), "deterministic_candidate_disagreement")))
    r = r.withColumn("qa_reasons", F.when(open_, F.concat(rules.qa_reasons(F.col("text"), F.col("session_topics"), candidates), foreign)).otherwise(F.array().cast(_NO_TEXTS)))
    doubtful = open_ & (F.size("qa_reasons") > 0)
    r = _ask(r, doubtful, _question(("Signals", F.col("_a")), ("Decision", F.col("_b")), ("Reasons", F.array_join("qa_reasons", ", "))), review, "_c", **how)
    r = r.withColumn("_e", _object("_c", "final_label string, final_confidence double, final_topics array<string>, evidence_quote string, qa_action string"))
    r = r.withColumn("_final", F.lower(F.trim("_e.final_label"))).withColumn("_sure", F.col("_e.final_confidence"))
    r = r.withColumn("failed", F.when(doubtful & (F.size(rules.choice_errors({"_final": rules.LABELS}, "_sure")) > 0), "review").otherwise(F.col("failed")))
    r = r.withColumn("qa_action", F.when(doubtful, F.coalesce("_e.qa_action", F.lit("revised_confidence"))).otherwise("confirmed"))
    r = r.withColumn("source", F.when(F.col("_shortcut").isNotNull(), "shortcut").when(F.col("_r.label").isNotNull(), "rules").when(doubtful, "review").otherwise("decision"))
    r = r.withColumn("topics", F.when(doubtful, rules.clean_topics(F.coalesce("_e.final_topics", "topics"), most)).otherwise(F.col("topics")))
    quote = F.coalesce(F.when(doubtful, F.nullif("_e.evidence_quote", F.lit(""))), F.when(open_, F.nullif("_d.evidence_quote", F.lit(""))), F.col("_s.evidence_quote"))
    r = r.withColumn("evidence_quote", quote)
    r = r.withColumn("label", F.when(doubtful, F.col("_final")).otherwise(F.col("label"))).withColumn("confidence", F.when(doubtful, F.col("_sure")).otherwise(F.col("confidence")))

    r = r.withColumn("_g", rules.enforced())
    r = r.withColumn("qa_action", F.when(open_ & F.col("_g.changed"), "revised_label").otherwise(F.col("qa_action")))
    r = r.withColumn("label", F.when(F.col("source") == "shortcut", "neutral").when(F.col("source") == "rules", F.col("_r.label")).otherwise(F.col("_g.label")))
    r = r.withColumn("confidence", F.when(F.col("source") == "shortcut", 0.95).when(F.col("source") == "rules", F.col("_r.confidence")).otherwise(F.col("_g.confidence")))
    done = scoring.validated(r, rules.chair_procedural(F.col("text"), F.col("raw_speaker"), F.col("chairs")) if procedural is None else procedural)
    kept = ("label", "confidence", "topics", "evidence_quote", "qa_action", "qa_reasons", "needs_recheck", "source")
    return done.select("session_id", "speech_index", *[F.when(F.col("failed").isNull(), F.col(c)).alias(c) for c in kept], "failed")


_RESULT = "speech_index int, constructiveness_label string, confidence double, topics array<string>, evidence_quote string, " + ", ".join(f"{n} string" for n in rules.SIGNALS) + ", argumentation_quality string"


def _own_result(results: Column) -> Column:
    """C18 for one speech: its result by index and quote, else by quote, else by index."""
    same = lambda x: x["speech_index"] == F.col("speech_index")
    blank = lambda x: F.trim(or_empty(x["evidence_quote"])) == ""
    fits = lambda x: quote_grounded(x["evidence_quote"], F.col("text"))
    first = lambda met: F.try_element_at(F.filter(results, met), F.lit(1))
    return F.coalesce(first(lambda x: same(x) & (blank(x) | fits(x))), first(lambda x: fits(x) & ~blank(x)), first(same))


def _checked(rows: DataFrame, result: str, procedural: Column, most: int, into: str) -> DataFrame:
    """R6 of a result as a struct: label, confidence, topics, evidence_quote, needs_recheck; null if its label or confidence is none."""
    names = [*rules.SIGNALS, "argumentation_quality"]
    r = rows.withColumn("label", F.lower(F.trim(F.col(f"{result}.constructiveness_label")))).withColumn("confidence", F.col(f"{result}.confidence")).withColumn("evidence_quote", F.col(f"{result}.evidence_quote"))
    for n in names:
        r = r.withColumn(n, F.coalesce(F.lower(F.trim(F.col(f"{result}.{n}"))), F.lit("weak" if n == "argumentation_quality" else "partial")))
    r = r.withColumn("_bad", F.size(rules.choice_errors({"label": rules.LABELS}, "confidence")) > 0).withColumn("topics", rules.clean_topics(F.col(f"{result}.topics"), most))
    r = scoring.validated(r, procedural)
    return r.withColumn(into, F.when(~F.col("_bad"), F.struct("label", "confidence", "topics", "evidence_quote", "needs_recheck"))).drop("_bad", "label", "confidence", "topics", "evidence_quote", "needs_recheck", *names)


def one_pass(speeches: DataFrame, factory: Factory, shortcuts: dict | None = None, procedural: Column | None = None, most: int = 3, **how) -> DataFrame:
    """session_id, speech_index, label, confidence, topics, evidence_quote, source, failed.

    speeches as in three_layer. After the shortcuts one question a speech; of the results in the answer the one
    that is meant for the speech counts. A speech without one, or whose result has no hold in it, is asked again
    once, and the second answer counts if it is valid.
    """
    line = rules.chair_procedural(F.col("text"), F.col("raw_speaker"), F.col("chairs")) if procedural is None else procedural
    r = speeches.withColumn("_shortcut", rules.shortcut(F.col("text"), F.col("interruption"), **(shortcuts or {})))
    open_ = F.col("_shortcut").isNull()
    r = scoring.with_results(_ask(r, open_, _question(), factory, "_answer", **how), "_answer", "_found")
    r = r.withColumn("_results", F.from_json("_found", f"array<struct<{', '.join(x.replace(' ', ':', 1) for x in _RESULT.split(', '))}>>"))
    r = r.withColumn("_own", _own_result(F.col("_results")))
    r = _checked(r, "_own", line, most, "_first")
    empty, none = open_ & (F.coalesce(F.size("_results"), F.lit(0)) <= 0), open_ & F.col("_own").isNull()
    again = (none & ~empty) | F.coalesce(F.col("_first.needs_recheck"), F.lit(False))
    r = scoring.with_results(_ask(r, open_ & again, _question(("Again", F.lit("Answer for this speech alone."))), factory, "_answer2", **how), "_answer2", "_found2")
    r = r.withColumn("_own2", F.from_json("_found2", f"array<struct<{', '.join(x.replace(' ', ':', 1) for x in _RESULT.split(', '))}>>")[0])
    r = _checked(r, "_own2", line, most, "_second")
    settled = F.struct(F.lit("neutral").alias("label"), F.lit(0.95).alias("confidence"), F.array().cast(_NO_TEXTS).alias("topics"), F.lit("").alias("evidence_quote"), F.lit(False).alias("needs_recheck"))
    r = r.withColumn("_end", F.when(~open_, settled).otherwise(F.coalesce("_second", "_first")))
    failed = F.when(open_ & F.col("_end").isNull(), F.when(empty, "empty").when(F.col("_own").isNull(), "missing").otherwise("invalid"))
    source = F.when(~open_, "shortcut").when(F.col("_second").isNotNull(), "recheck").when(F.col("_end").isNotNull(), "model")
    return r.select("session_id", "speech_index", "_end.label", "_end.confidence", "_end.topics", "_end.evidence_quote", source.alias("source"), failed.alias("failed"))


def classify(speeches: DataFrame, done: DataFrame, model: str, provider: str, factories: dict[str, Factory], **options) -> DataFrame:
    """The results of the speeches that `done` (session_id, speech_index) hasn't, by the architecture that the model's name implies.

    factories: signals, decide and review for three layers, or model for one pass.
    """
    spark = speeches.sparkSession
    kind = spark.range(1).select(scoring.model_settings(F.lit(model), F.lit(provider)).alias("s")).first().s.architecture
    pending = state.pending(speeches, done, ["session_id", "speech_index"])
    if kind == "three_layer":
        out = three_layer(pending, factories["signals"], factories["decide"], factories["review"], **options)
    else:
        out = one_pass(pending, factories["model"], **options)
    common = ["session_id", "speech_index", "label", "confidence", "topics", "evidence_quote", "source", "failed"]
    return out.select(*common, F.lit(kind).alias("architecture"))


def joined(rows: DataFrame, group: Sequence[str], order: str, text: str, most: int, into: str = "part") -> DataFrame:
    """group, part, text: the texts of a group in order, joined by blank lines as long as a part has at most `most` characters.

    A text too long alone is a part of its own. One aggregation, so that what made the texts runs once.
    """
    kind = "array<struct<size:bigint,texts:array<string>>>"
    items = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(text).alias("t"))))

    def step(acc, x):
        size, end = F.length(x["t"]).cast("long"), F.try_element_at(acc, F.lit(-1))
        new = F.array(F.struct(size.alias("size"), F.array(x["t"]).alias("texts")))
        grown = F.array(F.struct((end["size"] + size).alias("size"), F.concat(end["texts"], F.array(x["t"])).alias("texts")))
        return F.when((F.size(acc) == 0) | (end["size"] + size > most), F.concat(acc, new)).otherwise(F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), grown))

    folded = rows.groupBy(*group).agg(items.alias("i")).select(*group, F.posexplode(F.aggregate("i", F.array().cast(kind), step)).alias(into, "p"))
    return folded.select(*group, into, F.array_join("p.texts", "\n\n").alias("text"))


def extract_topics(chunks: DataFrame, factory: Factory, header: Column | None = None, cap: int = 4000, single: int = 82_000, window: int = 12_000, batch: int = 24_000, most: int = 20, **how) -> DataFrame:
    """session_id, mode, topics (F28), failed.

    chunks: session_id, chunk_index, text, and what `header` needs, the same for a session. Texts are capped with
    an ellipsis. A session of at most `single` characters is one question. Else each window of consecutive chunks
    is described, and the descriptions are reduced to topics; if they don't fit one batch, each batch is, and
    then the batches' topics are.
    """
    capped = F.when(F.length("text") > cap, F.concat(F.left("text", F.lit(cap)), F.lit("…"))).otherwise(F.col("text"))
    head = F.lit("") if header is None else header
    rows = chunks.select("session_id", "chunk_index", head.alias("head"), capped.alias("text"))
    plan = rows.groupBy("session_id").agg(F.when(F.sum(F.length("text")) <= single, "single_pass").otherwise("map_reduce").alias("mode"))
    rows = rows.join(plan, "session_id")
    keys = ["session_id", "head", "mode"]
    asks = lambda kind, text: F.concat(F.lit(f"{kind}\n"), F.col("head"), F.lit("\n\n"), text)

    whole = joined(rows.where("mode = 'single_pass'"), keys, "chunk_index", "text", 1 << 62, "batch")
    parts = joined(rows.where("mode = 'map_reduce'"), keys, "chunk_index", "text", window)
    told = scoring.scored(parts.withColumn("_ask", asks("DESCRIBE", F.col("text"))), "_ask", factory, into="told", **how)
    batches = joined(told.where("trim(told) <> ''"), keys, "part", "told", batch, "batch")
    first = whole.withColumn("_ask", asks("TOPICS", F.col("text"))).unionByName(batches.withColumn("_ask", asks("REDUCE", F.col("text"))))
    got = scoring.scored(first, "_ask", factory, into="answer", readable=is_json, **how).withColumn("found", scoring.topics_payload(F.col("answer"), most=most))
    lines = F.array_join(F.transform("found", lambda t: F.concat(F.lit("- "), t["label"], F.when(t["law_id"].isNotNull(), F.concat(F.lit(" ("), t["law_id"], F.lit(")"))).otherwise(""), F.when(t["description"] != "", F.concat(F.lit(": "), t["description"])).otherwise(""))), "\n")
    answers = F.array_sort(F.collect_list(F.struct("batch", "found", lines.alias("lines"))))
    by = got.groupBy(*keys).agg(answers.alias("b"), F.count("*").alias("n"))
    merged = F.array_join(F.filter(F.transform("b", lambda x: x["lines"]), lambda x: x != ""), "\n\n")
    last = scoring.scored(by.withColumn("_ask", F.when(F.col("n") > 1, asks("REDUCE", merged))), "_ask", factory, into="answer", readable=is_json, **how)
    topics = F.when(F.col("n") > 1, scoring.topics_payload(F.col("answer"), most=most)).otherwise(F.col("b")[0]["found"])
    return plan.join(last.select("session_id", topics.alias("topics")), "session_id", "left").select("session_id", "mode", "topics", (F.coalesce(F.size("topics"), F.lit(0)) <= 0).alias("failed"))


def run_session_topics(chunks: DataFrame, done: DataFrame, factory: Factory, model: str, allowed: DataFrame | None = None, **options) -> DataFrame:
    """session_id, topics, topics_source, mode, failed of the sessions that `done` (session_id) hasn't.

    allowed: session_id and allowed_laws, an array; a topic keeps its law only if the session names it.
    """
    out = extract_topics(state.pending(chunks, done, ["session_id"]), factory, **options)
    if allowed is not None:
        keep = lambda t: F.when(F.array_contains("allowed_laws", t["law_id"]), t["law_id"])
        out = out.join(allowed, "session_id", "left").withColumn("topics", F.when(F.coalesce(F.size("allowed_laws"), F.lit(0)) > 0, F.transform("topics", lambda t: t.withField("law_id", keep(t)))).otherwise(F.col("topics")))
    return out.select("session_id", "topics", F.lit(f"llm_v1:{model}").alias("topics_source"), "mode", "failed")

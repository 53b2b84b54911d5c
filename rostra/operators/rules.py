"""Rule tables: baseline labels, shortcuts, quality checks, enforcement and validation, as chains of when."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rostra.functions.text import hits, holds_any, let, or_empty, plain_word_count, plain_words, qa_text, rules_key, sentence_count, stripped

# The baseline's vocabulary, in normal form.
PROCEDURAL = ["ordine de zi", "supun votului", "vot", "cvorum", "microfon", "cartele", "sedinta", "va rog", "declar deschisa", "regulament"]
CONSTRUCTIVE = ["motiune", "cenzura", "proiect", "lege", "amendament", "articol", "ordonanta", "raport", "comisie", "buget"]
STRONG_CONSTRUCTIVE = ["motiune", "cenzura", "ordonanta", "amendament", "articol"]
ATTACKS = ["klaus iohannis", "presedinte ilegitim", "uzurpa functia", "impostor", "camarila", "acolitii", "dictatura", "tradare", "tradator", "ruinat tara"]
ROLL_CALL = [" absent", " prezent", "nu votez"]
GREETINGS = ["multumesc", "multumim", "va rog", "buna", "buna ziua", "buna dimineata", "buna seara"]
VOTES = ["supun la vot", "supunem la vot", "trecem la vot", "cine este pentru", "cine este contra", "cine se abtine", "votul a fost", "votul final", "ramane la votul final", "ramane a votul final"]
REPLIES = ["da", "nu", "prezent", "absent", "abtinere", "pentru", "contra"]
REPORT_MARKERS = ["raportul comisiei", "raport comun", "raport asupra", "in conformitate cu prevederile art", "comisia pentru"]
REPORT_SHAPE = r"(?isu)(?:în conformitate cu prevederile|raport\w*\s+(?:comun\s+)?(?:asupra|privind)).+(?:comisi[aei]|sesizat)"
CHAIR_MARKERS = ["va rog", "multumesc", "ramane la vot", "votul final", "dezbateri generale", "ordinea de zi", "trecem la", "cuvantul", "interventii", "nefiind amendamente"]
CHAIR_NAME = r"(?:domnul|doamna)\s+(?:deputat\s+|senator\s+)?([A-ZĂÂÎȘȚ][a-zăâîșț]+(?:[-][A-ZĂÂÎȘȚ]?[a-zăâîșț]+)*(?:\s+[A-ZĂÂÎȘȚ][a-zăâîșț]+(?:[-][A-ZĂÂÎȘȚ]?[a-zăâîșț]+)*)*)"
SIGNALS = ["policy_proposal", "policy_analysis", "public_interest_orientation", "partisan_rhetoric", "legislative_engagement", "procedural_content", "debate_advancement"]
FUNCTIONS = ["procedural", "substantive_support", "substantive_opposition", "partisan_attack", "symbolic_political_statement", "mixed"]
ARGUMENTATION = ["strong", "weak", "none"]
LABELS = ["constructive", "neutral", "non_constructive"]
QA_ACTIONS = ["confirmed", "revised_label", "revised_topics", "revised_confidence"]


def _verdict(label: str, topics: Column, confidence: float) -> Column:
    return F.struct(F.lit(label).alias("label"), topics.alias("topics"), F.lit(confidence).alias("confidence"))


def baseline(key: Column, topics: Column, session_topics: Column, attacks: Sequence[str] = ATTACKS, constructive: Sequence[str] = CONSTRUCTIVE, strong: Sequence[str] = STRONG_CONSTRUCTIVE,
             procedural: Sequence[str] = PROCEDURAL, roll_call: Sequence[str] = ROLL_CALL) -> Column:
    """Label, topics and confidence of a text in normal form, with its topics and those of its session."""
    none = F.array().cast("array<string>")

    def judged(of: Column) -> Column:
        k, own = of["k"], of["own"]
        debated = F.replace(F.replace(k, F.lit("proiectul ordinii de zi"), F.lit("ordinii de zi")), F.lit("proiect de ordine de zi"), F.lit("ordine de zi"))
        c, p, some = hits(debated, constructive), hits(k, procedural), F.size(own) > 0
        return (
            F.when(F.length(k) < 40, _verdict("neutral", own, 0.45)).when(hits(k, roll_call) >= 2, _verdict("neutral", own, 0.90))
            .when((hits(k, attacks) > 0) & ~some & (c == 0) & (p <= 1), _verdict("non_constructive", none, 0.80))
            .when(~some & (p > 0), _verdict("neutral", none, 0.72)).when(~some, _verdict("neutral", none, 0.58))
            .when((c > 0) & (p > 0) & ~holds_any(debated, strong), _verdict("neutral", own, 0.63)).when(c > 0, _verdict("constructive", own, 0.75))
            .otherwise(_verdict("neutral", own, 0.67))
        )

    return let(F.struct(key.alias("k"), F.array_intersect(topics, session_topics).alias("own")), judged)


def shortcut(text: Column, interruption: Column, greetings: Sequence[str] = GREETINGS, votes: Sequence[str] = VOTES, replies: Sequence[str] = REPLIES) -> Column:
    """R2: the reason why a speech is neutral without a model, or null; never after an interruption for procedure."""
    t = stripped(or_empty(text))
    key, n = rules_key(t), plain_word_count(t)
    words = F.transform(plain_words(t), rules_key)
    reason = (
        F.when((n >= 1) & (n <= 10) & holds_any(key, greetings), "greeting").when((n <= 60) & holds_any(key, votes), "vote").when((n <= 5) & t.rlike(r"^(Domnul|Doamna)\s+[A-ZĂÂÎȘȚŞŢ]"), "name_call")
        .when((n <= 3) & (F.size(words) > 0) & (F.size(F.array_except(words, F.array(*map(F.lit, replies)))) == 0), "short_reply")
    )
    return F.when(F.coalesce(interruption, F.lit("")) != "procedure_violation", reason)


def committee_report(text: Column, markers: Sequence[str] = REPORT_MARKERS, shape: str = REPORT_SHAPE, least: int = 50) -> Column:
    """F25."""
    t = stripped(or_empty(text))
    return (plain_word_count(t) >= least) & (hits(rules_key(t), markers) >= 2) & t.rlike(shape)


def chair_procedural(text: Column, speaker: Column, chairs: Column, markers: Sequence[str] = CHAIR_MARKERS) -> Column:
    """A short procedural line of a session's chair."""
    return is_chair(speaker, chairs) & (plain_word_count(text) <= 40) & holds_any(rules_key(text), markers)


def is_chair(speaker: Column, chairs: Column) -> Column:
    """A chair's name is part of the speaker's."""
    return F.exists(F.coalesce(chairs, F.array().cast("array<string>")), lambda n: F.contains(speaker, n))


def chairs(notes: Column, name: str = CHAIR_NAME) -> Column:
    """names of more than three letters after a form of address."""
    return F.array_distinct(F.filter(F.regexp_extract_all(or_empty(notes), F.lit(name), F.lit(1)), lambda n: F.length(n) > 3))


def _yes(*names: str) -> Column:
    out = F.lit(False)
    for n in names:
        out = out | (F.col(n) == "yes")
    return out


def after_signals(text: Column, chair: Column) -> Column:
    """Label, confidence and candidates that follow from the signals' columns alone."""
    bare = (F.col("procedural_content") == "yes") & (F.col("policy_proposal") == "no") & (F.col("policy_analysis") == "no") & (F.col("legislative_engagement") == "no")
    biased = chair & (plain_word_count(text) <= 40) & F.col("procedural_content").isin("yes", "partial") & ~_yes("policy_proposal", "policy_analysis", "legislative_engagement", "partisan_rhetoric")
    attack = _yes("partisan_rhetoric") & (F.col("policy_proposal") == "no") & (F.col("policy_analysis") == "no") & (F.col("argumentation_quality") == "none")
    build = (_yes("policy_proposal", "policy_analysis", "legislative_engagement") & (F.col("procedural_content") != "yes")) | committee_report(text)
    short = bare | biased
    candidates = F.when(short, F.array(F.lit("neutral"))).otherwise(F.array_compact(F.array(F.when(attack, F.lit("non_constructive")), F.when(build, F.lit("constructive")))))
    return F.struct(F.when(short, "neutral").alias("label"), F.when(bare, 0.9).when(biased, 0.85).alias("confidence"), candidates.alias("candidates"))


def mentions_topic(text: Column, topics: Column) -> Column:
    """Two tokens of four letters of a topic are in the text, or its only one."""
    key = qa_text(text)

    def met(topic):
        tokens = F.filter(F.regexp_extract_all(qa_text(topic), F.lit("([a-z0-9]+)"), F.lit(1)), lambda t: F.length(t) >= 4)
        n = F.size(F.filter(tokens, lambda t: F.contains(key, t)))
        return (n >= 2) | ((F.size(tokens) == 1) & (n == 1))

    return (key != "") & F.exists(topics, met)


def qa_reasons(text: Column, session_topics: Column, candidates: Column) -> Column:
    """Why a decision (label, confidence, topics beside the signals) needs a second look, in order."""
    label = F.col("label")
    substance = _yes("policy_proposal", "policy_analysis", "legislative_engagement", "public_interest_orientation")
    built = _yes("policy_proposal", "policy_analysis", "legislative_engagement")
    torn = (
        F.when(label == "neutral", ~_yes("procedural_content") & substance).when(label == "constructive", _yes("partisan_rhetoric") & ~built)
        .when(label == "non_constructive", ~_yes("partisan_rhetoric") & substance).otherwise(False)
    )
    weak = F.when(label == "constructive", ~built).when(label == "neutral", ~_yes("procedural_content")).when(label == "non_constructive", ~_yes("partisan_rhetoric")).otherwise(True)
    rules = {
        "low_confidence": F.col("confidence") < 0.70,
        "primary_function_mixed": F.col("primary_function") == "mixed",
        "analysis_and_partisan_conflict": _yes("policy_analysis") & _yes("partisan_rhetoric"),
        "procedural_partial_with_substantive_yes": (F.col("procedural_content") == "partial") & substance,
        "very_short_speech": (F.size(candidates) == 0) & (plain_word_count(text) <= 25) & (sentence_count(text) <= 2),
        "layer_b_inconsistent_with_layer_a": torn,
        "missing_topics_despite_topic_reference": (F.size("topics") == 0) & mentions_topic(text, session_topics),
        "label_weakly_supported_by_layer_a": weak,
    }
    return F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]))


def enforced() -> Column:
    """Label and confidence after the guidance, and whether it changed them."""
    low = lambda *names: F.forall(F.array(*map(F.col, names)), lambda x: x.isin("no", "partial"))
    target = (
        F.when(_yes("partisan_rhetoric") & (F.col("policy_proposal") == "no") & (F.col("policy_analysis") == "no"), "non_constructive")
        .when(_yes("procedural_content") & low("policy_proposal", "policy_analysis", "legislative_engagement", "public_interest_orientation", "partisan_rhetoric"), "neutral")
        .when(_yes("policy_proposal", "policy_analysis", "legislative_engagement") & ~_yes("partisan_rhetoric"), "constructive")
    )
    firm = _yes("policy_proposal") | (_yes("policy_analysis") & (F.col("argumentation_quality") == "strong")) | (_yes("legislative_engagement") & F.col("argumentation_quality").isin("strong", "weak"))
    floor = F.when(target == "constructive", F.when(firm, 0.72).otherwise(0.65)).when(target == "neutral", 0.75).otherwise(0.70)
    changed = F.coalesce(target != F.col("label"), F.lit(False))
    return F.struct(F.when(changed, target).otherwise(F.col("label")).alias("label"), F.when(changed, F.greatest("confidence", floor)).otherwise(F.col("confidence")).alias("confidence"), changed.alias("changed"))


def choice_errors(choices: dict[str, Sequence[str]], confidence: str | None = None) -> Column:
    """What is wrong with a row of model output: values outside their choices, and a confidence outside 0 to 1."""
    bad = [F.when(~F.coalesce(F.lower(F.trim(F.col(k))).isin([*v]), F.lit(False)), F.lit(f"{k} must be one of {sorted(v)}")) for k, v in choices.items()]
    if confidence:
        bad.append(F.when(~F.coalesce(F.col(confidence).between(0, 1), F.lit(False)), F.lit(f"{confidence} must be between 0.0 and 1.0")))
    return F.array_compact(F.array(*bad))


def clean_topics(topics: Column, most: int = 3) -> Column:
    """Trimmed, without blanks, the first of those alike but for case, `most` at most."""
    kept = F.filter(F.transform(F.coalesce(topics, F.array().cast("array<string>")), stripped), lambda t: t != "")
    lower = F.transform(kept, F.lower)
    return F.slice(F.filter(kept, lambda t, i: F.array_position(lower, F.lower(t)) == i + 1), 1, most)


def compatible(defaults: dict[str, str]) -> list[Column]:
    """Signals that are missing get their defaults."""
    return [F.coalesce(F.col(k), F.lit(v)).alias(k) for k, v in defaults.items()]


def write_errors(labels: Sequence[str] = LABELS, most: int = 5, long: int = 64) -> Column:
    """L2: what keeps an analysis (label, topics, confidence) from being written."""
    return F.array_compact(F.array(
        F.when(~F.col("label").isin([*labels]), F.lit("label")), F.when(F.size("topics") > most, F.lit("topics_count")),
        F.when(F.exists("topics", lambda t: (F.trim(t) == "") | (F.length(t) > long)), F.lit("topic_length")), F.when(~F.col("confidence").between(0, 1), F.lit("confidence")),
    ))



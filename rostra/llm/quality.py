"""Quality by weak supervision: rules vote or abstain, and expectation-maximisation weighs them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import cut

SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\x0b\x0c\r"
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_marks", "n_loud", "n_bare"]


def repeated_words(words: list[bytes], window: int = 8) -> int:
    """Words that lie in a window of `window` words that the text holds twice or more."""
    if len(words) <= window:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: 1 - window].tolist()
    windows = [joined[a:b] for a, b in zip(starts, ends[window - 1 :].tolist())]
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    mark = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(np.fromiter((often[w] > 1 for w in windows), bool, len(windows)))
    np.add.at(mark, at, 1)
    np.add.at(mark, at + window, -1)
    return int((np.cumsum(mark) > 0).sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts named in _COUNTS; all 0 for a null text."""
    if not text:
        return (0,) * len(_COUNTS)
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip(_BLANKS)]
    letters = "".join(filter(str.isalpha, text)) if not text.isascii() else raw.translate(None, _NOT_LETTERS).decode()
    return (
        len(words),
        len(text) - (len(raw) - len(raw.translate(None, _BLANKS))),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(letters),
        sum(map(str.isupper, letters)) if not letters.isascii() else len(letters) - len(letters.encode().translate(None, _UPPER)),
        sum(w[-1] in b".,;:!?" for w in words),
        raw.count(b"!!"),
        sum(not w.translate(None, SYMBOLS) for w in words),
    )


_UPPER = bytes(range(65, 91))
_NOT_LETTERS = bytes(x for x in range(256) if not (65 <= x < 91 or 97 <= x < 123))


def _counted(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in series:
        yield pd.DataFrame([text_counts(x) for x in texts], columns=_COUNTS)


def _rule(poor: Column, good: Column) -> Column:
    return F.when(poor, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """Each rule's vote on the counts: -1 poor, 1 good, 0 none; every rule abstains from a text without words."""
    words, chars, letters = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_letters"))
    share = lambda c, of: F.col(c) / of
    rules = {
        "long_enough": _rule(F.col("n_words") < 20, F.col("n_words") >= 40),
        "few_symbols": _rule(share("n_symbols", words) > 0.25, share("n_symbols", words) < 0.02),
        "little_repeated": _rule(share("n_repeat_words", words) > 0.2, share("n_repeat_words", words) < 0.02),
        "own_lines": _rule(share("n_dup_lines", F.greatest(F.col("n_lines"), F.lit(1))) > 0.3, (F.col("n_dup_lines") == 0) & (F.col("n_lines") > 2)),
        "mostly_lower": _rule(share("n_upper", letters) > 0.5, share("n_upper", letters) < 0.2),
        "calm": _rule(share("n_loud", words) > 0.1, (F.col("n_loud") == 0) & (F.col("n_words") >= 20)),
        "usual_words": _rule(~(chars / words).between(2.5, 12), (chars / words).between(3.5, 9)),
        "some_marks": _rule((F.col("n_words") > 60) & ((F.col("n_marks") == 0) | (share("n_marks", words) > 0.7)), share("n_marks", words).between(0.03, 0.4)),
        "mostly_letters": _rule(share("n_letters", chars) < 0.75, share("n_letters", chars) > 0.9),
        "few_bare_symbols": _rule(share("n_bare", words) > 0.1, (F.col("n_bare") == 0) & (F.col("n_words") >= 20)),
    }
    return {k: F.when(F.col("n_words") > 0, v).otherwise(0).cast("int") for k, v in rules.items()}


def weigh_rules(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior chance of good for each pattern of votes, the rules' accuracies, and the share of good.

    Each class has for each rule a chance of every vote; both are estimated in turn from the patterns'
    counts. Pseudo-counts say a rule is right four times in five, which also tells the classes apart.
    """
    n, rules = patterns.shape
    total = max(1.0, float(counts.sum()))
    seen = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    strength = 0.005 * total + 1
    belief = np.array([[0.5, 1.0, 2.0], [2.0, 1.0, 0.5]]) * strength  # rows: good, poor; columns: votes -1, 0, 1
    good = np.where((patterns < 0).any(axis=1), 0.1, 0.95)  # a first guess: what no rule finds poor is good
    share = 0.5
    chance = np.full((2, rules, 3), 1 / 3)
    for _ in range(rounds):
        share = (float(counts @ good) + strength) / (total + 2 * strength)
        for c, w in enumerate((counts * good, counts * (1 - good))):
            held = np.tensordot(w, seen, 1) + belief[c]
            chance[c] = held / held.sum(axis=1, keepdims=True)
        log = [np.einsum("nrv,rv->n", seen, np.log(chance[c])) for c in (0, 1)]
        odds = log[0] - log[1] + np.log(share / (1 - share))
        now = 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
        if np.abs(now - good).max(initial=0) < 1e-9:
            good = now
            break
        good = now
    voted = counts[:, None] * (patterns != 0)
    right = counts[:, None] * np.where(patterns > 0, good[:, None], np.where(patterns < 0, 1 - good[:, None], 0))
    return good, right.sum(axis=0) / np.maximum(voted.sum(axis=0), 1e-9), share


def _voted(docs: DataFrame) -> DataFrame:
    """doc_id, the counts and the votes, as text, of every row of docs; written once."""
    marks = F.concat_ws(",", *[v.cast("string") for v in votes().values()])
    return cut(docs.select("doc_id", F.pandas_udf(_counted, ", ".join(f"{n} long" for n in _COUNTS))(docs["text"]).alias("c")).select("doc_id", "c.*").select("*", marks.alias("votes")))


def _weighed(rated: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray, float]:
    """The patterns of votes, the chance that each is good, the rules' accuracies and the share of good; the driver gets a row a pattern."""
    held = rated.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()
    patterns = np.array([[int(v) for v in r[0].split(",")] for r in held], np.int64).reshape(-1, len(votes()))
    return [r[0] for r in held], *weigh_rules(patterns, np.array([r[1] for r in held], float))


def rate_quality(docs: DataFrame, keep: float = 0.5) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, quality and votes of every row of docs.

    quality is the posterior chance that the rules' votes mean a good text, kept that it reaches `keep`, also
    when it just does, and the base rule (20 words at least, repeated words 30 % at most) holds. Counts are over
    whole texts, however long; null and empty texts have none and fail the base rule; repeated rows and null ids
    are rated like any other; an empty table gives no rows; other columns are ignored. The driver gets one row for
    each pattern of votes, at most 3 ** 10.
    """
    rated = _voted(docs)
    patterns, good, _, _ = _weighed(rated)
    chance = docs.sparkSession.createDataFrame([(p, float(g)) for p, g in zip(patterns, good)], "votes string, quality double")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rated.join(F.broadcast(chance), "votes").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & (F.col("quality") >= keep)).alias("kept"), "quality", "votes"
    )


def rule_accuracies(docs: DataFrame) -> DataFrame:
    """rule, accuracy: how often, by the estimate, each rule's vote on docs is right when it doesn't abstain."""
    _, _, accuracy, _ = _weighed(_voted(docs))
    return docs.sparkSession.createDataFrame([(k, float(x)) for k, x in zip(votes(), accuracy)], "rule string, accuracy double")

"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import cut, released, share, taken

_LETTERS = re.compile(r"[^\W\d_]+")
STEM = 4


def features(text: str | None) -> Counter:
    """How often a text has each of its words, and each beginning of STEM letters with a dash, of longer words.

    The beginnings tell of compounds and endings: in languages that have many, a word itself is seldom met twice.
    """
    found = Counter(_LETTERS.findall(text.lower())) if text else Counter()
    begins: dict[str, int] = {}
    for word, n in found.items():
        if len(word) > STEM:
            x = word[:STEM] + "-"
            begins[x] = begins.get(x, 0) + n
    found.update(begins)
    return found


def _terms(text: str | None, known: frozenset[str]) -> set[str]:
    """The different features of a text that are known."""
    words = set(_LETTERS.findall(text.lower())) if text else set()
    return (words & known) | ({w[:STEM] + "-" for w in words if len(w) > STEM} & known)


def _likeness(text: str | None) -> int:
    """Least hash of a text's three-word runs: nearly always the same for near copies."""
    words = text.split() if text else []
    return min((xxhash.xxh64_intdigest(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0) >> 1


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each low up to its high, one range after the other, and the ranges' sizes."""
    size = high - low
    ends = np.cumsum(size)
    return np.repeat(low - ends + size, size) + np.arange(ends[-1] if len(ends) else 0), size


@dataclass
class Index:
    """Labelled examples as TF-IDF vectors of length 1, in postings by term, cut in blocks of examples.

    A cell is what one term has in one block. Its peak is the largest weight there, so a query's product with the
    peaks of a block bounds the cosine of every example of it: blocks whose bound is below the k-th best cosine
    found are never read. Only cells that hold something are kept. The first terms, if many examples have them, are
    rows of a matrix instead, with which some queries at once are multiplied; their products are bounds as well.
    """

    terms: dict[str, int]
    idf: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    prior: float
    block: int = 64
    k: int = 15
    slope: float = 1.0
    shift: float = 0.0
    common: np.ndarray = field(default=None)  # weights of the first terms, by term and example
    cells: np.ndarray = field(default=None)  # first cell of each term
    of: np.ndarray = field(default=None)  # block of each cell
    peak: np.ndarray = field(default=None)
    start: np.ndarray = field(default=None)  # first posting of each cell
    who: np.ndarray = field(default=None)
    weight: np.ndarray = field(default=None)

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        found = features(text)
        term = np.fromiter(map(self.terms.get, found, repeat(-1)), np.int64, len(found))
        n = np.fromiter(found.values(), np.float64, len(found))
        return self.weigh(term[term >= 0], n[term >= 0])

    def weigh(self, term: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weight = (1 + np.log(n)) * self.idf[term]
        return term, weight / max(1e-12, math.sqrt(float(weight @ weight)))

    def build(self, vectors: list[tuple[np.ndarray, np.ndarray]], rows: int = 1536) -> None:
        """rows: at most so many first terms, each of which one example in 128 has, become rows of the matrix."""
        blocks = max(1, -(-len(vectors) // self.block))
        who = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(t) for t, _ in vectors])
        term = np.concatenate([*[t for t, _ in vectors], np.empty(0, np.int64)]).astype(np.int64)
        weight = np.concatenate([*[w for _, w in vectors], np.empty(0)])
        few = np.flatnonzero(np.bincount(term, minlength=len(self.terms)) * 128 < max(1, len(vectors)))
        rows = min(rows, int(few[0]) if len(few) else len(self.terms))
        self.common = np.zeros((rows, len(vectors)))
        self.common[term[term < rows], who[term < rows]] = weight[term < rows]
        who, weight, term = who[term >= rows], weight[term >= rows], term[term >= rows]
        cell = term * blocks + who // self.block
        order = np.argsort(cell, kind="stable")
        cell, self.who, self.weight = cell[order], who[order], weight[order]
        self.start = np.flatnonzero(np.concatenate((np.ones(min(1, len(cell)), bool), cell[1:] != cell[:-1])))
        self.peak = np.maximum.reduceat(self.weight, self.start) if len(cell) else np.empty(0)
        self.of = (cell[self.start] % blocks).astype(np.int32)
        self.cells = np.searchsorted(cell[self.start], np.arange(len(self.terms) + 1) * blocks)
        self.start = np.append(self.start, len(cell))

    def _read(self, cell: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Sums of the postings of some cells, each times the query's weight, by example."""
        at, size = _ranges(self.start[cell], self.start[cell + 1])
        return np.bincount(self.who[at], self.weight[at] * np.repeat(weight, size), len(self.ids))

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], without: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each vector the k examples of the highest cosine above 0, and their cosines; ties go to the lower position.

        without: an example for each that doesn't count.
        """
        if not len(self.ids):
            return [(np.empty(0, np.int64), np.empty(0))] * len(queries)
        first = np.zeros((len(queries), len(self.common)))
        for i, (term, weight) in enumerate(queries):
            first[i, term[term < len(self.common)]] = weight[term < len(self.common)]
        return [self._nearest(t, w, c, without[i] if without else -1) for i, ((t, w), c) in enumerate(zip(queries, first @ self.common))]

    def _nearest(self, term: np.ndarray, weight: np.ndarray, cosine: np.ndarray, without: int) -> tuple[np.ndarray, np.ndarray]:
        """cosine: as far as the matrix tells, which is never too much."""
        weight, term = weight[term >= len(self.common)], term[term >= len(self.common)]
        cell, size = _ranges(self.cells[term], self.cells[term + 1])
        weight, block = np.repeat(weight, size), self.of[cell]
        bound = np.maximum.reduceat(cosine, np.arange(0, len(cosine), self.block))
        bound += np.bincount(block, weight * self.peak[cell], len(bound))
        need = max(0, len(cosine) - self.k - (without >= 0))
        first = bound >= np.partition(bound, max(0, len(bound) - 4))[max(0, len(bound) - 4)]
        now = first[block]
        cosine = cosine + self._read(cell[now], weight[now])
        more = (~first & (bound >= np.partition(cosine, need)[need] - 1e-9))[block]
        if more.any():
            cosine += self._read(cell[more], weight[more])
        if without >= 0:
            cosine[without] = 0
        need = max(0, len(cosine) - self.k)
        best = np.flatnonzero(cosine >= max(1e-12, np.partition(cosine, need)[need]))
        best = best[np.argsort(-cosine[best], kind="stable")][: self.k]
        return best, cosine[best]

    def vote(self, best: np.ndarray, cosine: np.ndarray) -> float:
        """Log odds of the neighbours' votes, weighted by squared cosine, with half a vote for the prior."""
        w = cosine * cosine
        share = (float(w @ self.toxic[best]) + 0.5 * self.prior) / (float(w.sum()) + 0.5)
        share = min(max(share, 1e-6), 1 - 1e-6)
        return math.log(share / (1 - share))

    def score(self, texts: list[str | None], step: int = 256) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        one_sided = not 0 < float(self.toxic.sum()) < len(self.toxic)
        for at in range(0, len(texts), step):
            for best, cosine in self.nearest([self.vector(x) for x in texts[at : at + step]]):
                yield min(self.prior, 0.5) if one_sided else 1 / (1 + math.exp(-(self.slope * self.vote(best, cosine) + self.shift))), best, cosine

    def calibrate(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """A logistic fit (Platt) of the labels to the votes that each example gets from all others.

        Examples weigh as their label does among all labelled rows.
        """
        met = (m for at in range(0, len(vectors), 256) for m in self.nearest(vectors[at : at + 256], list(range(at, min(at + 256, len(vectors))))))
        x = np.array([self.vote(*m) for m in met])
        y, n = self.toxic, len(vectors)
        ones = float(y.sum())
        if not 0 < ones < n:
            return
        goal = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (n - ones + 2))
        w = np.where(y > 0, self.prior / ones, (1 - self.prior) / (n - ones)) * n
        a, b = 1.0, 0.0
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            g = np.array([(w * (p - goal) * x).sum() + 1e-2 * (a - 1), (w * (p - goal)).sum()])
            v = w * p * (1 - p)
            h = np.array([[(v * x * x).sum() + 1e-2, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-6]])
            step = np.linalg.solve(h, g)
            a, b = a - step[0], b - step[1]
            if abs(step).max() < 1e-8:
                break
        if a > 0:
            self.slope, self.shift = float(a), float(b)


def _described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column(2).to_pylist()
        found = [features(x) for x in text]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([_likeness(x) for x in text], pa.int64()), pa.array([list(x) for x in found], pa.list_(pa.string())), pa.array([list(x.values()) for x in found], pa.list_(pa.int32()))],
            names=["doc_id", "toxic", "alike", "term", "n"],
        )


def fit(docs: DataFrame, labels: DataFrame, examples: int = 2500) -> Index:
    """An index of the rows of docs (doc_id, text) that labels (doc_id, toxic 0 or 1) has, with the document frequencies of all docs.

    Examples are a sample of at most `examples` ids, half of them toxic if there are so many, chosen by a
    hash of the id, before any text is read; of rows with the same id one text is kept, of rows with the same
    least three-word run one row. Every word and word beginning of an example is a term. A term's weight is its
    frequency, times its inverse document frequency over every row of docs, times how much it tells: the standard
    deviations, beyond two, by which its share of toxic examples is off theirs, and a little for all terms; for in
    the cosine of a long text the many words that say nothing would else drown the few that do. So the driver
    holds the terms of the sample and no more. Null labels are left out, of several labels of an id the highest
    counts; without labels, or with one label only, nothing can be told apart: every score is the share of toxic
    ones, but 0.5 at most.
    """
    kind = docs.schema["doc_id"].dataType
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast(kind).alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = cut(known.join(docs.select("doc_id"), "doc_id", "left_semi"))
    rate = known.agg(F.avg("toxic")).first()[0]
    prior = 0.0 if rate is None else float(rate)
    ids = cut(reduce(DataFrame.unionByName, [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples // 2) for y in (1, 0)]))
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    sample = cut(chosen.mapInArrow(_described, f"doc_id {kind.simpleString()}, toxic int, alike long, term array<string>, n array<int>"))
    single = cut(sample.groupBy("alike").agg(F.min_by(F.struct("doc_id", "toxic", "term", "n"), F.struct("doc_id", "toxic", "term")).alias("x")).select("x.*"))
    found = single.select("toxic", F.explode("term").alias("term")).groupBy("term").agg(F.sum("toxic").alias("a"), F.count("*").alias("m")).orderBy(F.desc("m"), "term").toArrow()
    vocabulary = {t: i for i, t in enumerate(found.column("term").to_pylist())}
    shared = share(docs.sparkSession, vocabulary)

    def frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen, rows = taken(shared), Counter(), 0
        known = frozenset(own)
        for batch in batches:
            rows += batch.num_rows
            for x in batch.column(0):
                seen.update(_terms(x.as_py(), known))
        yield pa.RecordBatch.from_arrays([pa.array([-1, *[own[t] for t in seen]], pa.int32()), pa.array([rows, *seen.values()], pa.int64())], names=["term", "n"])

    counts = docs.select("text").mapInArrow(frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(vocabulary) + 1)
    df[counts.column("term").to_numpy()] = counts.column("n").to_numpy()  # the last is that of all rows
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    index = _indexed(single, vocabulary, shared, idf * _telling(found.column("a").to_numpy(), found.column("m").to_numpy(), single), prior)
    shared.destroy()
    released(known, ids, sample, single)
    return index


def _telling(toxic: np.ndarray, of: np.ndarray, single: DataFrame) -> np.ndarray:
    """What the terms of `of` examples tell, `toxic` of which are toxic: in tens of standard deviations beyond two, and 0.02."""
    ones, every = single.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    p = ones / max(1, every)
    return 0.02 + np.maximum(0, np.abs(toxic - of * p) / np.sqrt(of * max(p * (1 - p), 1e-9)) - 2) / 10


def _indexed(single: DataFrame, vocabulary: dict[str, int], shared, idf: np.ndarray, prior: float) -> Index:
    def narrowed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = taken(shared)
        for batch in batches:
            terms = pa.array([[own[t] for t in ts] for ts in batch.column(2).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), terms, batch.column(3)], names=["doc_id", "toxic", "term", "n"])

    kind = single.schema["doc_id"].dataType
    # Lists of Python's numbers would take the driver ten times the memory of these arrays.
    rows = single.mapInArrow(narrowed, f"doc_id {kind.simpleString()}, toxic int, term array<int>, n array<int>").toArrow().combine_chunks()
    ids, toxic = rows.column("doc_id").to_pylist(), rows.column("toxic").to_pylist()
    term, n = ([x.values.to_numpy() for x in rows.column(c)] for c in ("term", "n"))
    order = sorted(range(len(ids)), key=lambda i: (-toxic[i], np.sort(term[i]).astype(">u4").tobytes(), ids[i]))
    index = Index(vocabulary, idf, np.array([ids[i] for i in order]), np.array([toxic[i] for i in order], np.float64), prior)
    vectors = [index.weigh(term[i].astype(np.int64), n[i].astype(np.float64)) for i in order]
    del rows, term, n
    index.build(vectors)
    index.calibrate(vectors)
    return index


def with_toxicity(docs: DataFrame, index: Index, bar: float = 0.7, evidence: int = 3, into: str = "toxicity") -> DataFrame:
    """docs and a column of score (0 to 1), predicted (1 from bar on) and evidence: the nearest examples' ids, labels and cosines.

    Whole texts are scored, whatever their length; a null, empty or unfamiliar text gets the score of the prior.
    Of examples with the same cosine those with the lower place in the index count, so reruns agree. Rows are
    judged where they lie: ids, repeated rows and other columns don't matter; an empty table stays empty; a column
    called as `into` is replaced.
    """
    name = {"i": "bigint", "U": "string"}.get(index.ids.dtype.kind, "bigint")
    kind = f"struct<score:double,predicted:int,evidence:array<struct<doc_id:{name},toxic:int,cosine:double>>>"
    shared = share(docs.sparkSession, index)

    @F.pandas_udf(kind)
    def judge(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = taken(shared)
        for texts in series:
            rows = []
            for score, best, cosine in own.score(list(texts)):
                rows.append((score, int(score >= bar), [{"doc_id": own.ids[i].item(), "toxic": int(own.toxic[i]), "cosine": float(c)} for i, c in zip(best[:evidence].tolist(), cosine[:evidence].tolist())]))
            yield pd.DataFrame(rows, columns=["score", "predicted", "evidence"])

    return docs.withColumn(into, judge(docs["text"]))

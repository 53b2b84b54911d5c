"""Benchmark decontamination by the q-gram lemma over diagonal bands, verified by banded alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import cut, fresh, share, taken

Q = 8


def _plain(text: str) -> bytes:
    """A-Z lowered, and each run of space and the controls 0x09-0x0D one space."""
    return b" ".join(text.encode().lower().split())


def _grams(text: np.ndarray) -> np.ndarray:
    """The Q bytes from each position on, as one number."""
    out = np.empty(max(0, len(text) - Q + 1), "<u8")
    for k in range(min(Q, len(out))):
        whole = (len(text) - k) // Q
        out[k::Q] = np.frombuffer(text[k : k + whole * Q].tobytes(), "<u8")
    return out


def banded_distance(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int] | None:
    """Least edit distance, if at most `most`, of item to a part of text, and where that part ends.

    text is a band: what the item can meet on the diagonals in question. Row by row; the minimum that runs
    along a row is one of sums with the position, so each row is a few vector operations.
    """
    at = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, ch in enumerate(item, 1):
        best = np.empty_like(row)
        best[0] = i
        best[1:] = np.minimum(row[:-1] + (text != ch), row[1:] + 1)
        row = np.minimum.accumulate(best - at) + at
        if row.min() > most:
            return None
    end = int(row.argmin())
    return (int(row[end]), end) if row[end] <= most else None


#: Entries that are looked at together: it bounds memory, not work.
_MOST = 1 << 21


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers from each low up to its high, one range after the other."""
    size = high - low
    ends = np.cumsum(size)
    return np.repeat(low - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def _pieces(width: np.ndarray) -> Iterator[tuple[int, int]]:
    """Slices of widths that sum up to _MOST or little more."""
    ends = np.cumsum(width)
    at = 0
    while at < len(width):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _MOST, "right")))
        yield at, to
        at = to


class GramIndex:
    """The items' q-grams: how often each item has each, and a bitmap that turns most positions of a text away before any search."""

    def __init__(self, items: list[tuple[int, str]], error: float):
        self.items = [(i, np.frombuffer(_plain(t), np.uint8)) for i, t in items]
        self.items = [(i, t) for i, t in self.items if len(t) >= Q]
        self.budget = [max(0, min(int(error * len(t)), (len(t) - Q) // Q)) for _, t in self.items]
        self.least = np.array([len(t) - Q + 1 - k * Q for (_, t), k in zip(self.items, self.budget)], np.int64)
        grams = [np.unique(_grams(t), return_counts=True) for _, t in self.items]
        gram = np.concatenate([*[g for g, _ in grams], np.empty(0, np.uint64)])
        item = np.repeat(np.arange(len(grams)), [len(g) for g, _ in grams])
        order = np.argsort(gram, kind="stable")
        self.item, self.often = item[order], np.concatenate([*[n for _, n in grams], np.empty(0, np.int64)])[order].astype(np.int64)
        self.gram, self.first = np.unique(gram[order], return_index=True)
        self.first = np.append(self.first, len(order))
        self.place = np.full(len(self.gram), -1, np.int32)  # of the q-grams among those of one item, for a while
        self.bits = max(16, int(len(gram) * 32).bit_length())
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self.slot(self.gram)] = True

    def slot(self, gram: np.ndarray) -> np.ndarray:
        return (gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def scan(self, texts: list[bytes]) -> list[list[tuple[int, int, int, int]]]:
        """(item id, start, end, distance) of the items that each text holds; the texts are searched as one."""
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        if not len(self.gram):
            return out
        joined = np.frombuffer((b"\x00" * Q).join(texts), np.uint8)
        ends = np.cumsum(np.array([len(t) + Q for t in texts], np.int64))
        gram = _grams(joined)
        at = np.flatnonzero(self.seen[self.slot(gram)])
        place = np.minimum(np.searchsorted(self.gram, gram[at], "left"), len(self.gram) - 1)
        real = self.gram[place] == gram[at]
        at, place = at[real], place[real]
        bounds = np.searchsorted(at, np.concatenate(([0], ends)))
        pair = np.unique(np.repeat(np.arange(len(texts)), np.diff(bounds)) * len(self.gram) + place)
        for row, item in self._candidates(pair // len(self.gram), pair % len(self.gram)):
            a, b = int(bounds[row]), int(bounds[row + 1])
            out[row] += self._regions(texts[row], item, at[a:b] - (int(ends[row]) - len(texts[row]) - Q), place[a:b])
        return out

    def _candidates(self, row: np.ndarray, gram: np.ndarray) -> Iterator[tuple[int, int]]:
        """Text and item where the text has so many of the item's q-grams, anywhere; rows are in order, each q-gram of a text is there once."""
        low, high = self.first[gram], self.first[gram + 1]
        held, counts = -1, np.zeros(len(self.items), np.int64)
        for a, b in _pieces(high - low):
            entry, rows = _ranges(low[a:b], high[a:b]), np.repeat(row[a:b], (high - low)[a:b])
            for s, e in zip((starts := np.flatnonzero(np.diff(rows, prepend=-1))).tolist(), [*starts[1:].tolist(), len(rows)]):
                if rows[s] != held:
                    yield from ((held, k) for k in np.flatnonzero(counts >= self.least).tolist() if held >= 0)
                    held, counts = int(rows[s]), np.zeros(len(self.items), np.int64)
                np.add.at(counts, self.item[entry[s:e]], self.often[entry[s:e]])
        yield from ((held, k) for k in np.flatnonzero(counts >= self.least).tolist() if held >= 0)

    def _bands(self, k: int, at: np.ndarray, gram: np.ndarray) -> Iterator[int]:
        """Bands of diagonals in which a text that has the q-grams gram (numbers) at `at` has enough of those of item k, in order.

        An alignment with e edits stays within e + 1 neighbouring diagonals, so it lies whole in a band of
        twice that width, where bands start at every multiple of it. A q-gram of the item counts once a band,
        which bounds the number of shared ones from above, so no region is lost. The text is gone through in
        parts that overlap by a band's length: each band lies in one of them.
        """
        body = self.items[k][1]
        step, own = self.budget[k] + 1, np.searchsorted(self.gram, _grams(body))
        order = np.argsort(own, kind="stable")
        mine, first = np.unique(own[order], return_index=True)
        self.place[mine] = np.arange(len(mine))
        real = self.place[gram]
        self.place[mine] = -1
        at, real = at[real >= 0], real[real >= 0]
        first = np.append(first, len(own))
        low, high = first[real], first[real + 1]
        width = len(body) + 3 * step
        long = 32 * width if (high - low).sum() > _MOST else int(at.max(initial=0)) + width
        told = -(1 << 62)
        for begin in range(0, max(1, int(at.max(initial=0)) - width + 1), long):
            s, e = np.searchsorted(at, [begin, begin + long + width]).tolist()
            pairs = np.empty(0, np.int64)
            for a, b in _pieces(high[s:e] - low[s:e]):
                where = order[_ranges(low[s + a : s + b], high[s + a : s + b])]
                base = (np.repeat(at[s + a : s + b], (high - low)[s + a : s + b]) - where) // step
                some = np.concatenate([base, base - 1]) * (len(body) + 1) + np.concatenate([where, where])
                pairs = np.unique(np.concatenate([pairs, np.unique(some)]))
            bands, counts = np.unique(pairs // (len(body) + 1), return_counts=True)
            for band in bands[counts >= self.least[k]].tolist():
                if band > told:
                    told = band
                    yield band

    def _regions(self, text: bytes, k: int, at: np.ndarray, gram: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Where text holds item k; of regions that overlap the one of the least distance, then the first."""
        name, body = self.items[k]
        step = self.budget[k] + 1
        found: list[tuple[int, int, int, int]] = []
        for band in self._bands(k, at, gram):
            a, b = max(0, band * step), min(len(text), (band + 2) * step + len(body))
            if found and found[-1][3] == 0 and a < found[-1][2] and b <= found[-1][2] + 2 * step:
                continue  # the exact copy that was just found fills this band
            exact = text.find(body.tobytes(), a, b)
            met = (0, exact - a + len(body)) if exact >= 0 else banded_distance(body, np.frombuffer(text, np.uint8)[a:b], self.budget[k])
            if not met:
                continue
            one = (name, max(0, a + met[1] - len(body)), a + met[1], met[0])
            if found and one[1] < found[-1][2]:
                found[-1] = min(found[-1], one, key=lambda x: x[3])
            else:
                found.append(one)
        return found


def with_benchmark_hits(docs: DataFrame, benchmark: DataFrame, error: float = 0.1, block: int = 8 << 20, into: str = "hits") -> DataFrame:
    """docs and a column of the benchmark items that each text holds whole, nearly: array of item_id, start, end, distance.

    Both sides are compared with A-Z lowered and white space squeezed; start and end are bytes of that form.
    A region counts whose edit distance to the item is at most error times the item's length, and never more
    than the q-gram lemma can vouch for: with k edits at least len - q + 1 - k * q of the item's q-grams stay
    in place up to k + 1 diagonals. Of regions of an item that overlap, the one of the least distance is given,
    then the first. Items under 8 bytes and null items are ignored; items that are alike are each found. The
    benchmark is a stated query set; a benchmark of more than `block` characters is dealt by a hash into blocks of
    about so many, each of which has a pass over the documents of its own, written before the next, so neither the
    driver nor a task holds more than one. Texts are read whole, in bounded memory. Null and empty texts have no
    hits, an empty benchmark gives none. Rows are judged where they lie, so ids may be null or repeated, and
    columns of any other name pass through; one that is called as `into` is replaced.
    """
    items = benchmark.where("text is not null").select("item_id", "text")
    blocks = max(1, -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // block))
    found = docs.withColumn(into, F.array().cast(_HITS))
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        if part:
            shared = share(docs.sparkSession, [(r[0], r[1]) for r in part])
            found = found.withColumn(into, F.concat(into, _search(shared, error)(found["text"])))
            if blocks > 1:
                found = cut(found)
                shared.unpersist()
    return found


def _search(items, error: float):
    @F.pandas_udf(_HITS)
    def search(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grams = GramIndex(taken(items), error)
        for texts in series:
            out: list = []
            for some in _runs(texts):
                out += [[dict(zip(("item_id", "start", "end", "distance"), x)) for x in hits] for hits in grams.scan(some)]
            yield pd.Series(out, dtype=object)

    return search


_HITS = "array<struct<item_id:bigint,start:bigint,end:bigint,distance:bigint>>"


def _runs(texts: pd.Series, most: int = 2 << 20) -> Iterator[list[bytes]]:
    held, size = [], 0
    for x in texts:
        held.append(_plain(x or ""))
        size += len(held[-1])
        if size >= most:
            yield held
            held, size = [], 0
    yield held


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, item_id, start, end, distance: a row for each region of a document that holds a benchmark item."""
    return with_benchmark_hits(docs.select("doc_id", "text"), benchmark, **options).select("doc_id", F.inline("hits"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without the rows that hold a benchmark item; columns stay."""
    hits = fresh(docs, "hits")
    return with_benchmark_hits(docs, benchmark, into=hits, **options).where(F.size(hits) == 0).drop(hits)

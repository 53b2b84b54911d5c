"""Repeated byte strings by a sparse enhanced suffix array: its common-prefix intervals give maximal repeats.

Of every string of `length` bytes the piece of GRAM bytes with the least hash is its anchor, so equal strings
have their anchor at the same place. Only suffixes that start at anchors are sorted: those of one anchor hash
are a small suffix array, whose common-prefix intervals, met with the strings to the left of the anchors, give
the repeats. What lies around an anchor goes no further than the strings that have it as anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import cut

GRAM = 32
_RUN = 1 << 19
#: Bytes that are searched at once: positions have 24 bits.
_PART = 1 << 23


def _gram_hashes(text: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each position on, as polynomials that double in length."""
    h, base, m = text.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, 1
    while m < GRAM:
        h = h[:-m] * np.uint64(base) + h[m:]
        base, m = base * base % (1 << 64), 2 * m
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(32))


def anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all anchors of some texts: text number, anchor, first and last start of the strings it stands for, hash.

    Ties of the least hash go to the leftmost piece.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    offset = np.concatenate(([0], np.cumsum(sizes)))
    joined = np.frombuffer(b"".join(texts), np.uint8)
    none = np.empty(0, np.int64)
    if len(joined) < length:
        return none, none, none, none, none
    h = _gram_hashes(joined)
    low = (h & ~np.uint64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)
    need, m = length - GRAM + 1, 1
    while 2 * m <= need:
        low = np.minimum(low[:-m], low[m:])
        m *= 2
    if need > m:
        low = np.minimum(low[: len(low) - (need - m)], low[need - m :])
    whole = sizes >= length
    starts = np.concatenate([*[np.arange(a, b - length + 1) for a, b in zip(offset[:-1][whole].tolist(), offset[1:][whole].tolist())], none]).astype(np.int64)
    if not len(starts):
        return none, none, none, none, none
    at = (low[starts] & np.uint64((1 << 24) - 1)).astype(np.int64)
    # At the end of a text no later string has the same anchor, as anchors lie within their text.
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.append(first[1:], len(at)) - 1
    at, begin, end = at[first], starts[first], starts[last]
    own = np.searchsorted(offset, at, "right") - 1
    return own, at - offset[own], begin - offset[own], end - offset[own], h[at].view(np.int64)


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Keys and texts of rows (key, text), each key once, in runs of about _RUN bytes."""
    seen: set[int] = set()
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, x in zip(batch.column(0).to_pylist(), batch.column(1)):
            if key in seen:
                continue
            seen.add(key)
            if text := (x.as_py() or "").encode():
                keys.append(key)
                texts.append(text)
                size += len(text)
            if size >= _RUN:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def _pieces(keys: list[int], texts: list[bytes], length: int, part: int) -> Iterator[tuple[int, int, bytes]]:
    """Texts as (key, offset, bytes): a long one goes in parts that overlap so that each string of `length` lies in one of them.

    An anchor whose strings start in two parts has a row of each; these share length - 1 bytes, so they don't repeat each other.
    """
    for key, text in zip(keys, texts):
        for at in range(0, max(1, len(text)), part):
            yield key, at, text[at : at + part + length - 1]


def _hash_counts(length: int, part: int = _PART):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _runs(batches):
            for group in _grouped(keys, texts, length, part):
                h, n = np.unique(anchors([t for _, _, t in group], length)[4], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], names=["hash", "n"])

    return run


def _grouped(keys: list[int], texts: list[bytes], length: int, part: int) -> Iterator[list[tuple[int, int, bytes]]]:
    some, size = [], 0
    for piece in _pieces(keys, texts, length, part):
        if some and size + len(piece[2]) > part:
            yield some
            some, size = [], 0
        some.append(piece)
        size += len(piece[2])
    if some:
        yield some


def _anchor_rows(length: int, part: int = _PART):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for keys, texts in _runs(batches):
            for group in _grouped(keys, texts, length, part):
                own, at, begin, end, h = anchors([t for _, _, t in group], length)
                around = np.fromiter((digest(group[o][2][b : e + length], (a - b) * 65536 + a - e) for o, a, b, e in zip(own.tolist(), at.tolist(), begin.tolist(), end.tolist())), np.uint64, len(own))
                shift = np.array([p[1] for p in group], np.int64)[own]
                place = (at + shift) << 32 | (at - begin) << 16 | (at - end)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(around.view(np.int64)), pa.array(np.array([p[0] for p in group], np.int64)[own]), pa.array(place)], names=["hash", "around", "key", "place"])

    return run


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(3).compress
    for keys, texts in _runs(batches):
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([pack(t) for t in texts], pa.binary())], names=["key", "packed"])


def _span(place: int, length: int) -> tuple[int, int, int]:
    """Anchor, and begin and end of what the strings of an anchor cover."""
    at, before, after = place >> 32, (place >> 16) & 65535, place & 65535
    return at, at - before, at - after + length


def _surroundings(length: int):
    """Reads (packed, wanted: array of hash, place); gives group, key, place, and the bytes before (backwards) and from the anchor on."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: list[tuple] = []
            for key, packed, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                text = unpack(packed.as_py())
                for w in wanted.as_py():
                    at, begin, end = _span(w["place"], length)
                    out.append((w["hash"], 0, length - GRAM, w["place"], key, at, text[begin:at][::-1], text[at:end], w["hot"]))
                    if len(out) > 20_000:
                        yield _rows(out)
                        out = []
            yield _rows(out)

    return run


_AROUND = "group long, low int, high int, hull long, key long, at long, before binary, after binary, hot boolean"


def _rows(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out)) or [[]] * 9
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)], names=["group", "low", "high", "hull", "key", "at", "before", "after", "hot"])


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals (length, first, last) of a sorted list, children before parents; lcp[i] is that of i-1 and i."""
    stack = [(0, 0)]
    for i, here in enumerate([*lcp[1:], -1], 1):
        first = i - 1
        while stack and stack[-1][0] > here:
            length, first = stack.pop()
            yield length, first, i - 1
        if here >= 0 and (not stack or stack[-1][0] < here):
            stack.append((here, first))
    # what is left begins at 0 with no common prefix


def repeats_of(members: list[tuple[bytes, bytes]], length: int) -> list[tuple[int, int, int]]:
    """(member, bytes before, bytes after) of the strings of `length` or more around the anchors that occur twice.

    The members' suffixes are sorted, and the stack scan of their common prefixes gives the intervals. In each,
    the members are sorted by what lies to the left: where neighbours differ, the repeat can't be extended to
    the left, so the longest left part that a member shares in the interval makes its maximal repeat there.
    """
    order = sorted(range(len(members)), key=lambda i: members[i][1])
    lcp = [0, *[_common(members[a][1], members[b][1]) for a, b in zip(order, order[1:])]]
    found: dict[tuple[int, int], int] = {}
    for right, first, last in intervals(lcp):
        if right < GRAM:
            continue
        inside = sorted(order[first : last + 1], key=lambda i: members[i][0])
        shared = [0, *[_common(members[a][0], members[b][0]) for a, b in zip(inside, inside[1:])], 0]
        for k, i in enumerate(inside):
            left = max(shared[k], shared[k + 1])
            if left + right >= length and found.get((i, left), 0) < right:
                found[i, left] = right
    return [(i, left, right) for (i, left), right in found.items()]


def _solve(length: int):
    """Reads (group, key, at, before, after) sorted by group; gives key, start, end of repeated strings, and the repeat's own hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and held[0][0] != row[0]:
                    _finish(held, length, out)
                    held = []
                held.append(row)
            yield _spans(out)
        out = []
        if held:
            _finish(held, length, out)
        yield _spans(out)

    return run


def _finish(rows: list[tuple], length: int, out: list[tuple]) -> None:
    if len(rows) < 2:
        return
    for i, left, right in repeats_of([(r[3], r[4]) for r in rows], length):
        out.append((rows[i][1], rows[i][2] - left, rows[i][2] + right, _body_hash(rows[i][3][:left], rows[i][4][:right])))


def _body_hash(before: bytes, after: bytes) -> int:
    return xxhash.xxh64_intdigest(before[::-1] + after) - (1 << 63)


def _spans(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], names=["key", "start", "end", "repeat"])


def _divided(length: int):
    """Rows of groups as rows of their two halves.

    A group holds strings with low to high bytes before the anchor. Those of a half share at least its low bytes
    before the anchor and length - high from it on, so rows that differ there have no string in common and part
    company. A row takes along what the strings of the half cover, and its hash, the hull.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            out: list[tuple] = []
            for group, low, high, _, key, at, before, after, hot in zip(*[c.to_pylist() for c in batch.columns]):
                mid = (low + high) // 2
                for a, b in ((low, mid), (mid + 1, high)):
                    first, last = max(a, length - len(after)), min(b, len(before))
                    if a > b or first > last:
                        continue
                    left, right = before[:last], after[: length - first]
                    core = digest(after[: length - b], digest(before[:a], (group + a) & 0xFFFFFFFF))
                    out.append((core - (1 << 63), a, b, digest(right, digest(left, first)) - (1 << 63), key, at, left, right, hot))
                if len(out) > 20_000:
                    yield _rows(out)
                    out = []
            yield _rows(out)

    return run


def _hulls(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole of rows (key, at, before, after) that others have as well, as spans."""
    for batch in batches:
        yield _spans([(key, at - len(x), at + len(y), _body_hash(x, y)) for key, at, x, y in zip(*[c.to_pylist() for c in batch.columns])])


def _scanned(around: DataFrame, length: int, most: int) -> DataFrame:
    """key, start, end, repeat of the strings of `length` that different surroundings of an anchor have in common.

    A group is scanned in one task. A group of more than `most` rows is divided first, by the bytes before the
    anchor of its strings, until its parts are small or hold one string; rows that have all of a part in common go
    on as one. Rows are few: a row has a part only where its neighbourhood is shared at all.
    """
    span = "key long, start long, end long, repeat long"
    columns = ["group", "key", "at", "before", "after"]
    scan = lambda rows: rows.select(*columns).repartition("group").sortWithinPartitions("group").mapInArrow(_solve(length), span)
    found = scan(around.where("not hot"))
    left = around.where("hot")
    while not left.isEmpty():
        parts = cut(left.mapInArrow(_divided(length), _AROUND))
        alike = cut(parts.groupBy("group", "hull").agg(F.count("*").alias("n"), F.min(F.struct("key", "at")).alias("one")))
        equal = parts.join(alike.where("n > 1").select("group", "hull"), ["group", "hull"], "left_semi")
        found = found.unionByName(equal.select("key", "at", "before", "after").mapInArrow(_hulls, span))
        sizes = alike.groupBy("group").agg(F.count("*").alias("m")).where("m > 1")
        ones = alike.select("group", "hull", "one").join(sizes, "group").select("group", "hull", "one.key", "one.at", (F.col("m") > most).alias("crowded"))
        kept = parts.drop("hot").join(ones, ["group", "hull", "key", "at"]).withColumnRenamed("crowded", "hot").select(*around.columns)
        kept = cut(kept)
        found = found.unionByName(scan(kept.where("not hot")))
        left = kept.where("hot")
    return found


def maximal_repeats(docs: DataFrame, length: int = 200, most: int = 2000, part: int = _PART) -> DataFrame:
    """key, start, end, repeat: the occurrences of byte strings of `length` or more that texts hold twice or more.

    docs has key (long, the same for equal texts) and text. An occurrence goes as far as the strings that share
    its anchor; occurrences of the same bytes have the same `repeat`. Each text counts once: what several rows
    have as their whole text is left to the caller. Together the occurrences cover exactly the bytes that a
    string of `length` covers which starts elsewhere too, in other texts or the same.

    Surroundings that are equal from end to end are repeats as they stand and need no sorting. The others of an
    anchor are sorted and scanned together; an anchor with more than `most` is divided by more of its context
    until each part can be, see _scanned.
    """
    if not GRAM <= length < (1 << 16):
        raise ValueError(f"length must be {GRAM} to {(1 << 16) - 1}")
    texts = docs.select("key", "text")
    again = cut(texts.mapInArrow(_hash_counts(length, part), "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).where("n > 1").select("hash"))
    rows = texts.mapInArrow(_anchor_rows(length, part), "hash long, around long, key long, place long")
    shared = cut(rows.join(again, "hash", "left_semi"))
    one = F.struct("key", "place")
    groups = cut(shared.groupBy("hash", "around").agg(F.min(one).alias("first"), (F.min(one) != F.max(one)).alias("equal")))
    many = groups.groupBy("hash").agg(F.count("*").alias("m")).where("m > 1").select("hash", (F.col("m") > most).alias("hot"))
    wanted = groups.join(cut(many), "hash").groupBy("first.key").agg(F.collect_list(F.struct("hash", F.col("first.place").alias("place"), "hot")).alias("wanted"))
    around = cut(texts.mapInArrow(_packed, "key long, packed binary").join(wanted, "key").select("key", "packed", "wanted").mapInArrow(_surroundings(length), _AROUND).dropDuplicates(["group", "key", "hull"]))

    # All with equal surroundings repeat each other over the whole of them.
    at, before, after = F.shiftright("place", 32), F.shiftright("place", 16).bitwiseAND(F.lit(65535)), F.col("place").bitwiseAND(F.lit(65535))
    whole = shared.join(groups.where("equal").select("hash", "around"), ["hash", "around"], "left_semi").select("key", (at - before).alias("start"), (at - after + length).alias("end"), F.col("around").alias("repeat"))
    return whole.unionByName(_scanned(around, length, most))


def _cleaned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out = []
        for key, packed, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            text, kept, at, removed, n = unpack(packed.as_py()), hashlib.sha256(), 0, 0, 0
            end = -1
            for s in sorted((s["start"], s["end"]) for s in spans.as_py()):
                if s[0] > end:
                    kept.update(text[at : s[0]])
                    n += 1
                    removed += s[1] - s[0]
                else:
                    removed += max(0, s[1] - end)
                end = at = max(end, s[1])
            kept.update(text[at:])
            out.append((key, removed, n, kept.hexdigest()))
        cols = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, [pa.int64(), pa.int64(), pa.int64(), pa.string()])], names=["key", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of docs, without its repeated strings.

    A byte goes if a string of `length` bytes that covers it also starts anywhere else, in this or another row;
    the texts as given decide. Null texts count as empty; texts shorter than `length` stay; of repeated rows
    nothing is left if they are long enough; an empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), F.xxhash64(text, F.octet_length(text)).alias("key"))
    rows = cut(keyed.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")))
    several = rows.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key", F.lit(True).alias("several"))
    spans = cut(maximal_repeats(keyed, length).select("key", "start", "end").groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    alone = spans.join(several, "key", "left_anti")
    cleaned = keyed.select("key", "text").mapInArrow(_packed, "key long, packed binary").join(alone, "key").mapInArrow(_cleaned, "key long, n_removed long, n_spans long, kept_sha256 string")
    gone = (F.col("n_bytes") >= length) & F.coalesce("several", F.lit(False))
    empty = hashlib.sha256().hexdigest()
    return (
        rows.join(several, "key", "left").join(cleaned, "key", "left")
        .select(
            "doc_id", "n_bytes",
            F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(gone, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        )
    )

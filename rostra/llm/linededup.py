"""Line deduplication by a deletion-neighbourhood join: near-equal lines go, the earliest stays."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import cut, share, taken

_digest = xxhash.xxh64_intdigest
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, 7) for w in words), np.uint64, len(words))


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n, _BASE, np.uint64))))


def half_keys(words: list[bytes], plain: bytes, least: int) -> list[int]:
    """Keys of which two lines within one word edit, the longer of `least` words or more, share at least one.

    With the shorter line's words cut in the middle, an edit leaves one side alone. Each line cuts itself as
    if it were the shorter one and as if it were the longer by one word. plain is the words, joined by spaces.
    """
    n, keys = len(words), set()
    ends = list(accumulate(map(len, words)))
    for m in (n, n - 1):
        if m >= least - 1:
            first, last = m // 2, m - m // 2
            keys.add(_digest(plain[: ends[first - 1] + first - 1], 2 * first) >> 1)
            keys.add(_digest(plain[ends[n - last - 1] + n - last if n > last else 0 :], 2 * last + 1) >> 1)
    return sorted(keys)


def variants(h: np.ndarray) -> np.ndarray:
    """Hash of the words without each one in turn, then of all of them: sums of word hash times a power of the position."""
    n = len(h)
    powers = _powers(n)
    terms = h * powers[:n]
    before = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
    down = h[1:] * powers[: n - 1]  # each word after the first, one place to the left
    after = np.concatenate((np.cumsum(down[::-1], dtype=np.uint64)[::-1], np.zeros(1, np.uint64)))
    return np.append(before[:n] + after, before[n])


def within_one(a: list[bytes], b: list[bytes]) -> bool:
    """Whether one word edit at most (insert, delete, replace) turns a into b."""
    if abs(len(a) - len(b)) > 1:
        return False
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    m = 0
    while m < min(len(a), len(b)) - n and a[-1 - m] == b[-1 - m]:
        m += 1
    return max(len(a), len(b)) - n - m <= 1


#: Bits of the map that tells which lines' words to fetch; at any size of the corpus, what it lets through is checked by a join.
_MAP = 1 << 25


def _lines_of(text: str | None) -> Iterator[tuple[int, list[bytes], bytes, int, int]]:
    """Number, words, plain form and its hash in two halves, of the lines that have a word."""
    for i, line in enumerate(text.encode().split(b"\n") if text else ()):
        if words := line.split():
            plain = b" ".join(words)
            yield i, words, plain, *struct.unpack(">qq", xxhash.xxh3_128_digest(plain))


def _places(least: int):
    """(doc_id, text_hash, text) to (doc_id, text_hash, line, h, g, halves); halves are null for short lines, and where a batch has had the line."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, out, seen = batch.column(0).to_pylist(), batch.column(1).to_pylist(), [], set()
            for k, x in enumerate(batch.column(2)):
                for i, w, plain, h, g in _lines_of(x.as_py()):
                    new = len(w) >= least - 1 and (h, g) not in seen
                    out.append((ids[k], marks[k], i, h, g, half_keys(w, plain, least) if new else None))
                    seen.add((h, g))
            cols = list(zip(*out)) or [[]] * 6
            kinds = [batch.column(0).type, pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)], names=["doc_id", "text_hash", "line", "h", "g", "halves"])

    return run


def _mapped(hashes: DataFrame) -> np.ndarray:
    """A bit map of the values of h, of _MAP bits: at most _MAP / 64 rows come to the driver."""
    at = F.pmod("h", F.lit(_MAP))
    rows = hashes.select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(h, {_MAP}) % 64 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(_MAP // 64, np.int64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return out


def _fetch(wanted):
    """(text) to (h, g, words) of the lines whose h the map may have, each once a batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = taken(wanted).tobytes()
        for batch in batches:
            found: dict[tuple[int, int], bytes] = {}
            for x in batch.column(0):
                for _, _, plain, h, g in _lines_of(x.as_py()):
                    at = h % _MAP
                    if bits[at >> 3] >> (at & 7) & 1:
                        found[h, g] = plain
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.int64()), pa.array([k[1] for k in found], pa.int64()), pa.array(list(found.values()), pa.binary())], names=["h", "g", "words"])

    return run


def _variants(least: int):
    """The variants of lines; of one word less than `least` only all of its words, as it can be but the shorter of a pair."""

    def run(lines: pd.Series) -> pd.Series:
        every = ([variants(_hashes(w))[0 if len(w) >= least else -1 :].view(np.int64).tolist() for w in (bytes(x).split(b" ") for x in lines)])
        return pd.Series(every, dtype=object)

    return run


def _close(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([within_one(bytes(x).split(b" "), bytes(y).split(b" ")) for x, y in zip(a, b)], dtype=bool)


def line_verdicts(docs: DataFrame, least: int = 5) -> DataFrame:
    """doc_id, text_hash, line, dropped (`copy` or `near`) of every line that an earlier one makes needless.

    Lines are the parts of texts between line feeds; those without a word are never dropped. Earlier is by
    doc_id (null first), text hash and line number. A line goes if an earlier one has the same words, or if one
    edit of a word (insert, delete, replace) makes it an earlier one and the longer of both has `least` words or
    more: four words in five are then the same. Whether the earlier one stays doesn't matter. Rows alike in doc_id
    and text count as one document, but each has its verdicts.

    Equal lines meet as one, with the earliest place. Of these, only lines that share a half with another
    emit deletion variants; their words are fetched by a second reading of the texts. Lines alike without
    their i-th word are one replacement apart; a line alike to another without a word is one insertion apart.
    So the earliest of each such set is all that its members need, a minimum summed up before the shuffle;
    the pair is then verified on the words themselves.
    """
    marked = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = cut(marked.mapInArrow(_places(least), f"doc_id {kind}, text_hash long, line int, h long, g long, halves array<long>"))
    place = F.struct("doc_id", "text_hash", "line")
    lines = cut(rows.groupBy("h", "g").agg(F.min(place).alias("at"), F.first("halves", ignorenulls=True).alias("halves"), (F.count("*") > 1).alias("again")))
    halves = lines.where("halves is not null").select("h", "g", F.explode("halves").alias("half"))
    shared = cut(halves.groupBy("half").agg((F.min("h") != F.max("h")).alias("several")).where("several").select("half"))
    partners = cut(halves.join(shared, "half", "left_semi").select("h", "g").distinct())
    words = docs.select("text").mapInArrow(_fetch(share(docs.sparkSession, _mapped(partners))), "h long, g long, words binary")
    some = cut(words.join(partners, ["h", "g"], "left_semi").groupBy("h", "g").agg(F.min("words").alias("words")).join(lines.select("h", "g", "at"), ["h", "g"]))

    rests = some.select("h", "g", "at", F.pandas_udf(_variants(least), "array<long>")("words").alias("rests"))
    every = rests.select("h", "g", "at", F.posexplode("rests").alias("place", "rest"), F.size("rests").alias("n"))
    emitted = every.withColumn("whole", F.col("place") == F.col("n") - 1).drop("n")
    # Variants that no other line has are most of them; what is left is small.
    alike = emitted.where("not whole").groupBy("rest", "place").agg(F.count("*").alias("m")).where("m > 1").select("rest")
    telling = alike.unionByName(rests.select(F.element_at("rests", -1).alias("rest"))).distinct()
    hits = cut(emitted.join(telling, "rest", "left_semi"))
    one = F.struct("at", "h", "g")
    replaced = hits.where("not whole").groupBy("rest", "place").agg(F.min(one).alias("first"))
    deleted = hits.where("not whole").groupBy("rest").agg(F.min(one).alias("part"))
    entire = hits.where("whole").groupBy("rest").agg(F.min(one).alias("first"))
    found = (
        hits.where("not whole").join(replaced, ["rest", "place"]).select("h", "g", "at", "first")
        .unionByName(hits.where("not whole").join(entire, "rest").select("h", "g", "at", "first"))
        .unionByName(hits.where("whole").join(deleted, "rest").select("h", "g", "at", F.col("part").alias("first")))
        .where(F.col("first.at") < F.col("at")).select("h", "g", F.col("first.h").alias("oh"), F.col("first.g").alias("og")).distinct()
    )
    texts = some.select("h", "g", "words")
    near = found.join(texts, ["h", "g"]).join(texts.toDF("oh", "og", "other"), ["oh", "og"]).where(F.pandas_udf(_close, "boolean")("words", "other")).select("h", "g", F.lit(True).alias("near")).distinct()
    # Only lines that occur again or are near an earlier one can go.
    first = F.col("at").eqNullSafe(place)
    judged = cut(lines.select("h", "g", "at", "again").join(near, ["h", "g"], "left").where("again or near").drop("again"))
    return rows.select("doc_id", "text_hash", "line", "h", "g").join(judged, ["h", "g"]).where(~first | F.col("near").isNotNull()).select("doc_id", "text_hash", "line", F.when(first, "near").otherwise("copy").alias("dropped"))


def _without(texts: pd.Series, lines: pd.Series) -> pd.Series:
    """Each text without the lines of some numbers; null where there is no text."""

    def one(text: str | None, numbers) -> str | None:
        if text is None:
            return None
        gone = set(numbers.tolist())
        return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)

    return pd.Series([one(t, n) for t, n in zip(texts, lines)], dtype=object)


def dedup_lines(docs: DataFrame, least: int = 5) -> DataFrame:
    """doc_id, text (without dropped lines; null stays null), n_lines, n_copies, n_near of every row of docs.

    n_lines counts lines with a word. Whole texts are read, at a cost in proportion to their lines; an empty text
    stays empty. Repeated rows each come out; an empty table gives no rows; other columns are ignored.
    """
    line = F.struct("line", "dropped")
    of = lambda kind: F.size(F.filter("lines", lambda x: x["dropped"] == kind)).cast("long")
    dropped = line_verdicts(docs, least).groupBy("doc_id", "text_hash").agg(F.collect_set(line).alias("lines"))
    dropped = dropped.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("lines.line").alias("lines"), of("copy").alias("n_copies"), of("near").alias("n_near"))
    d = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    held = d.join(dropped, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    left = F.pandas_udf(_without, "string")(F.when(F.col("lines").isNotNull(), F.col("text")), F.coalesce("lines", F.array().cast("array<int>")))
    return held.select(
        "doc_id",
        F.when(F.col("lines").isNull(), F.col("text")).otherwise(left).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))).cast("long").alias("n_lines"),
        F.coalesce("n_copies", F.lit(0)).cast("long").alias("n_copies"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )

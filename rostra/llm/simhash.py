"""SimHash fingerprints, and covering locality-sensitive hashing that misses no pair within the radius."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rostra.llm.common import cut, fresh, released
from rostra.llm.components import connected_components

BITS = 64


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """The hash of each word shingle of a text, repeats included; one of all its words if they are no more than a shingle."""
    words = text.encode().lower().split() if text else []  # bytes: A-Z only, and splits at 0x20, 0x09-0x0D only
    if not words:
        return np.empty(0, "<u8")
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(b" ".join(words), 42)], "<u8")
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts[: len(starts) + 1 - shingle].tolist(), ends[shingle - 1 :].tolist())], "<u8")


def _majority(hashes: np.ndarray) -> np.ndarray:
    """For each row of hashes the bits that more than half of them have; 0 for none."""
    votes = np.zeros((len(hashes), BITS), np.int64)
    for at in range(0, hashes.shape[1], 1 << 16):
        part = np.ascontiguousarray(hashes[:, at : at + (1 << 16)])
        votes += np.unpackbits(part.view(np.uint8).reshape(*part.shape, 8), axis=2, bitorder="little").sum(axis=1, dtype=np.int64)
    return np.packbits(2 * votes > hashes.shape[1], axis=1, bitorder="little").view("<u8")[:, 0]


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of the word shingles of a text, repeats included; 0 if it has no word."""
    return int(_majority(shingle_hashes(text, shingle)[None, :])[0])


def word_fingerprints(text: str | None, families: int) -> np.ndarray:
    """SimHashes of the set of words of a text: one for each of some families, whose hashes are mixed apart."""
    own = np.array([xxhash.xxh64_intdigest(w, 42) for w in set(text.encode().lower().split())] if text else [], "<u8")
    h = own[None, :] + np.arange(1, families + 1, dtype="<u8")[:, None] * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return _majority(h ^ (h >> np.uint64(31)))


def with_fingerprint(docs: DataFrame, keep: list[str], shingle: int = 4) -> DataFrame:
    """The columns `keep` of docs and the fingerprint fp of whole texts, as a signed long."""
    schema = StructType([*docs.select(*keep).schema.fields, StructField("fp", LongType())])

    def prints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.fromiter((fingerprint(x.as_py(), shingle) for x in batch.column(0)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fp.view(np.int64))], names=schema.names)

    return docs.select("text", *keep).mapInArrow(prints, schema)


def with_candidate_prints(docs: DataFrame, keep: list[str], families: int, shingle: int) -> DataFrame:
    """The columns `keep` of docs, the fingerprints p0, p1, ... of the set of words, and check, shingles and size.

    These are the fingerprint, a hash and the number of the different shingles of `shingle` words.
    """
    names = [*(f"p{i}" for i in range(families)), "check", "shingles", "size"]
    schema = StructType([*docs.select(*keep).schema.fields, *[StructField(n, LongType()) for n in names]])

    def prints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, len(names)), np.uint64)
            for i, x in enumerate(batch.column(0)):
                text = x.as_py()
                once = np.unique(shingle_hashes(text, shingle))
                out[i, :families] = word_fingerprints(text, families)
                out[i, families:] = _majority(once[None, :])[0], xxhash.xxh64_intdigest(once.tobytes()), len(once)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *[pa.array(np.ascontiguousarray(c).view(np.int64)) for c in out.T]], names=schema.names)

    return docs.select("text", *keep).mapInArrow(prints, schema)


def covering_masks(radius: int, turn: int = 0) -> np.ndarray:
    """2**(radius+1) - 1 bit masks such that any `radius` differing bits fall outside of one of them.

    Each bit gets a vector of radius+1 binary digits; mask v holds the bits whose vector has an odd number of
    digits in common with v. The vectors of `radius` bits span less than the whole space, so some v has an
    even number in common with each of them. `turn` deals the vectors differently to the bits.
    """
    top = 1 << (radius + 1)
    vectors = np.random.default_rng(1000 + turn).permutation(np.resize(np.arange(1, top), BITS))
    odd = np.bitwise_count(vectors[None, :] & np.arange(1, top)[:, None]) & 1
    return (odd.astype(np.uint64) << np.arange(BITS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _stars(parts: np.ndarray, points: np.ndarray, checks: np.ndarray, radius: int, apart: int) -> list[tuple[int, int]]:
    """Links between the parts of some points that steps within both radii join: as many as join them, not one a pair."""
    names, label = np.unique(parts, return_inverse=True)
    open_, out = len(names) - 1, []
    for i in range(len(points) - 1):
        if not open_:
            break
        near = i + 1 + np.flatnonzero((label[i + 1 :] != label[i]) & (np.bitwise_count(points[i + 1 :] ^ points[i]) <= radius) & (np.bitwise_count(checks[i + 1 :] ^ checks[i]) <= apart))
        for other in set(label[near].tolist()) - {int(label[i])}:
            low, high = sorted((other, int(label[i])))
            label[label == high] = low
            out.append((int(names[low]), int(names[high])))
            open_ -= 1
    return out


_LINK = ["a", "b", "bucket", "fp", "check"]


def _links(radius: int, apart: int, most: int | None):
    """Reads rows (bucket, part, fp, check) sorted by bucket; gives links a, b between parts, or, in a, the part of a point of a bucket above most, with the point.

    Links that others of the task imply are left out, so a task gives fewer links than it meets parts.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 4
        passing: int | None = None  # the bucket that is being handed on unsolved
        above: dict[int, int] = {}

        def root(x: int) -> int:
            while (y := above.get(x, x)) != x:
                above[x] = above.get(y, y)
                x = y
            return x

        def solve(last: bool) -> tuple[pa.RecordBatch, int]:
            nonlocal passing
            key, part, fp, check = held
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            ends = np.append(starts[1:], len(key))
            done = len(key) if last else int(starts[-1])
            out: list[list] = [[], [], [], [], []]
            size = ends - starts
            wanted = size > 1 if passing is None else (size > 1) | (key[starts] == passing)
            for k in np.flatnonzero(wanted).tolist():
                s, e = int(starts[k]), int(ends[k])
                large = most is not None and (size[k] > most or passing == key[s])
                if large:
                    passing, done = int(key[s]), max(done, e)
                    for column, values in zip(out, (part[s:e].tolist(), [None] * (e - s), [passing] * (e - s), fp[s:e].tolist(), check[s:e].tolist())):
                        column += values
                if e <= done:
                    for a, b in _stars(part[s:e], fp[s:e].view(np.uint64), check[s:e].view(np.uint64), radius, apart):
                        if (x := root(a)) != (y := root(b)):
                            above[max(x, y)] = min(x, y)
                            for column, value in zip(out, (a, b, None, None, None)):
                                column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=_LINK), done

        for batch in batches:
            held = [np.concatenate((h, batch.column(i).to_numpy(zero_copy_only=False))) for i, h in enumerate(held)]
            if len(held[0]):
                out, done = solve(False)
                held = [h[done:] for h in held]
                yield out
        if len(held[0]):
            yield solve(True)[0]

    return run


def _renamed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows with the column part replaced by the component that found (node, component) has for it."""
    now = found.select(F.col("node").alias("_was"), F.col("component").alias("_is"))
    return rows.join(now, rows["part"] == now["_was"], "left").withColumn("part", F.coalesce("_is", "part")).drop("_was", "_is")


def covering_parts(points: DataFrame, prints: list[str], radius: int = 4, apart: int = BITS, most: int = 4096, rounds: int = 4) -> DataFrame:
    """node, part (the least node of its part) of points (node, check, and the fingerprints named in prints).

    Points are joined, directly or by others, that differ in `radius` bits at most in any one of the prints,
    and in `apart` at most in check. Each print has its turn: every point goes to one bucket of each table that
    covers the radius, buckets are linked in one task, and the points learn their part. Only parts are linked,
    so what one print has joined costs the next ones no more links. Of a bucket of more than `most` points
    those that share a task are linked; if it is not one part then, its points go to a further round, where another
    covering divides it by more of the bits. After `rounds` so few bits are free that buckets are bounded.
    """
    parts = points.select("node", F.col("node").alias("part"), "check", *prints)
    for name in prints:
        left = parts.select(F.lit(0).cast("long").alias("bucket"), "part", F.col(name).alias("fp"), "check")
        for turn in range(rounds):
            masks = [int(m) - (1 << 64) if m >= 1 << 63 else int(m) for m in covering_masks(radius, turn).tolist()]
            tables = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(m).cast("long").alias("m")) for t, m in enumerate(masks)])).alias("x")
            keyed = left.select("bucket", "part", "fp", "check", tables).select(F.xxhash64("bucket", "x.t", F.col("fp").bitwiseAND(F.col("x.m")), F.lit(turn)).alias("bucket"), "part", "fp", "check")
            last = turn == rounds - 1
            out = cut(keyed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_links(radius, apart, None if last else most), ", ".join(f"{n} long" for n in _LINK)))
            found = connected_components(out.where("bucket is null").select("a", "b"))
            old, parts = parts, cut(_renamed(parts, found))
            released(old)
            members = out.where("bucket is not null").select("bucket", F.col("a").alias("part"), "fp", "check")
            if last or members.isEmpty():
                released(out, found)
                break
            members = cut(_renamed(members, found))
            released(out, found)
            several = members.groupBy("bucket").agg((F.min("part") != F.max("part")).alias("several")).where("several").select("bucket")
            left = members.join(several, "bucket", "left_semi")
    return parts.select("node", "part")


def simhash_groups(docs: DataFrame, keep: list[str] | None = None, shingle: int = 4, radius: int = 4) -> DataFrame:
    """doc_id (or the columns `keep`), fingerprint, component_id of every row of docs.

    Fingerprints that differ in at most `radius` bits link. component_id is the smallest doc_id that links
    reach. Null and empty texts have fingerprint 0 and link like any other; long texts count whole; null ids are
    reached but never the smallest unless there are no others; repeated rows and ids are kept; an empty table
    gives no rows; other columns are ignored. Copies meet as one fingerprint before any pairing.
    """
    keep = keep or ["doc_id"]
    rows = cut(with_fingerprint(docs, keep, shingle))
    points = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    parts = covering_parts(points.select(F.col("fp").alias("node"), "fp", F.lit(0).cast("long").alias("check")), ["fp"], radius)
    named = points.join(parts, points["fp"] == parts["node"])
    least = named.groupBy("part").agg(F.min("least").alias("component_id"))
    of = named.join(least, "part").select("fp", "component_id")
    return rows.join(of, "fp").select(*keep, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_links(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """For each part of some sets that steps of a Jaccard of `least` join, links (position) from its first to all others.

    A step meets, by the lists of the sets that hold an element, only those sets no part has yet; the lists are
    made anew as these get fewer, so a group in which most are near each other costs little more than its size.
    """
    size = np.array([len(x) for x in sets], np.int64)
    _, element = np.unique(np.concatenate([*sets, np.empty(0, np.uint64)]), return_inverse=True)
    bounds = np.concatenate(([0], np.cumsum(size)))
    order = np.argsort(element, kind="stable")
    owner, of = np.repeat(np.arange(len(sets)), size)[order], element[order]
    first = np.searchsorted(of, np.arange(of[-1] + 2 if len(of) else 1))
    free, listed, out = np.ones(len(sets), bool), len(sets), []
    for root in range(len(sets)):
        if not free[root]:
            continue
        free[root], todo = False, [root]
        while todo and (left := np.count_nonzero(free)):
            if 2 * left < listed:
                owner, of = owner[stay := free[owner]], of[stay]
                first, listed = np.searchsorted(of, np.arange(len(first))), left
            i = todo.pop()
            own = element[bounds[i] : bounds[i + 1]]
            n = first[own + 1] - first[own]
            at = np.repeat(first[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
            common = np.bincount(owner[at], minlength=len(sets))
            near = np.flatnonzero(free & (common / np.maximum(size + size[i] - common, 1) >= least)).tolist()
            free[near] = False
            out += [(root, j) for j in near]
            todo += near
    return out


def _sets(shingle: int):
    """Reads (text, component, blocks, shingles); gives the different shingle hashes in place of the text, at the end."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = pa.array([np.unique(shingle_hashes(x.as_py(), shingle)).tobytes() for x in batch.column(0)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], hashes], names=["component", "blocks", "shingles", "hashes"])

    return run


def _near(least: float):
    """Reads (component, low, high, shingles, hashes) sorted by the first three; gives links of shingles that are alike in these."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, sets = None, [], []

        def solve() -> pa.RecordBatch:
            links = near_links(sets, least) if len(sets) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([nodes[x[side]] for x in links], pa.int64()) for side in (0, 1)], names=["a", "b"])

        for batch in batches:
            out = []
            for *here, node, hashes in zip(*[c.to_pylist() for c in batch.columns[:4]], batch.column(4)):
                if here != key:
                    out.append(solve())
                    key, nodes, sets = here, [], []
                nodes.append(node)
                sets.append(np.frombuffer(hashes.as_py(), "<u8"))
            yield from (x for x in out if x.num_rows)
        yield solve()

    return run


def shingle_links(docs: DataFrame, members: DataFrame, shingle: int, least: float, most: int = 1024, hashes: int = 1 << 20) -> DataFrame:
    """Links a, b between the `shingles` of members whose shingle sets have a Jaccard of `least` or more.

    members has component, shingles, size, and own_id and own_hash, the doc_id and text hash of a row of docs
    (doc_id, text_hash, text) that has them. All pairs of a component count. One of more than `most` members
    or `hashes` shingles is dealt over blocks, and each pair of blocks is a task's.
    """
    blocks = F.greatest(F.ceil(F.count("*") / most), F.ceil(F.sum("size") / hashes), F.lit(1)).cast("long")
    several = members.groupBy("component").agg(F.count("*").alias("n"), blocks.alias("blocks")).where("n > 1").drop("n")
    wanted = members.join(several, "component").select("component", "blocks", "shingles", "own_id", "own_hash")
    found = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["own_id"]) & (docs["text_hash"] == wanted["own_hash"])).select("text", "component", "blocks", "shingles")
    sets = cut(found.mapInArrow(_sets(shingle), "component long, blocks long, shingles long, hashes binary").dropDuplicates(["component", "shingles"]))
    block = "pmod(xxhash64(shingles), blocks)"
    pairs = F.explode(F.expr(f"if(blocks = 1, array(struct(0L as low, 0L as high)), transform(filter(sequence(0L, blocks - 1), o -> o <> {block}), o -> struct(least(o, {block}) as low, greatest(o, {block}) as high)))"))
    dealt = sets.withColumn("x", pairs).select("component", "x.low", "x.high", "shingles", "hashes")
    return dealt.repartition("component", "low", "high").sortWithinPartitions("component", "low", "high").mapInArrow(_near(least), "a long, b long")


def keep_one(docs: DataFrame, families: int = 4, radius: int = 4, confirm: int = 5, apart: int = 18, least: float = 0.8, most: int = 1024) -> DataFrame:
    """docs with one row of each group of near copies: that of the smallest doc_id, then the smallest text hash.

    Two texts link if the sets of their five-word shingles have a Jaccard of `least` or more. Which texts are
    compared is what their fingerprints say: texts of which one of `families` fingerprints of the set of words,
    which covering hashing finds, and that of five-word shingles are close are candidates, and all are compared
    that candidates join, directly or by others. At a similarity of 0.8 the latter differ in 10 of 64 bits, give
    or take 3, and hardly ever in more than 18; the former in 4, give or take 2, each for itself. Columns stay.
    Of rows alike in doc_id and text one is kept, by its other columns' hash; a null doc_id only where a group
    has no other. Texts without a word are one group; whole texts count; an empty table stays empty. Only ids
    and hashes take part in the grouping, and the texts of candidates in the comparison; the texts are joined
    once to the kept.
    """
    mark, own, kept_mark, n = (fresh(docs, x) for x in ("text_hash", "kept_id", "kept_hash", "rows_in_group"))
    marked = docs.withColumn(mark, F.xxhash64("text"))
    read = marked.select("doc_id", "text", F.col(mark).alias("text_hash"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    prints = [f"p{i}" for i in range(families)]
    rows = with_candidate_prints(read, ["doc_id", "text_hash"], families, confirm)
    nodes = cut(rows.groupBy("shingles").agg(F.min(first).alias("k"), F.count("*").alias("n"), *[F.min(c).alias(c) for c in (*prints, "check", "size")]))
    parts = covering_parts(nodes.withColumnRenamed("shingles", "node"), prints, radius, apart)
    several = parts.groupBy("part").agg(F.count("*").alias("m")).where("m > 1").select("part")
    grouped = parts.join(several, "part", "left_semi")
    members = nodes.join(grouped, nodes["shingles"] == grouped["node"]).select(F.col("part").alias("component"), "shingles", "size", F.col("k.doc_id").alias("own_id"), F.col("k.text_hash").alias("own_hash"))
    members = cut(members)
    near = connected_components(shingle_links(read, members, confirm, least, most))
    whole = nodes.join(near.withColumnRenamed("component", "part"), nodes["shingles"] == near["node"], "left").withColumn("part", F.coalesce("part", "shingles"))
    kept = cut(whole.groupBy("part").agg(F.min("k").alias("k"), F.sum("n").alias(n)).select(F.col("k.doc_id").alias(own), F.col("k.text_hash").alias(kept_mark), n))
    released(nodes, members, near)
    found = marked.join(kept, F.col("doc_id").eqNullSafe(F.col(own)) & (F.col(mark) == F.col(kept_mark)))
    # Only a group of several rows can hold the kept row twice.
    columns = [F.col(f"`{c}`") for c in docs.columns]
    single = found.where(F.col(n) == 1).select(*columns)
    several = found.where(F.col(n) > 1).groupBy(own, kept_mark).agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("whole")).select("whole.*")
    return single.unionByName(several)

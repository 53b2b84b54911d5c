from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostra.llm import mixing, sharding


def plain_jump(key: int, n: int) -> int:
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int(float(b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)
    for n in (1, 2, 24, 25, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [plain_jump(int(k), n) for k in keys]


def test_manifest(spark):
    rows = [(i, f"text {i} é") for i in range(400)] + [(7, "text 7 é")] * 30 + [(None, None), (7, None)]
    got = sharding.shard_manifest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    slots: dict[int, list[int]] = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        key = int.from_bytes(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).digest()[:8], "big")
        assert (r.shard, r.grown_shard) == (plain_jump(key, 24), plain_jump(key, 25)) and r.grown_shard in (r.shard, 24)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    one = next(r for r in got if r.doc_id == 11)
    assert (one.size, one.text_crc32) == (len("text 11 é".encode()) + 8, zlib.crc32("text 11 é".encode()))
    assert sharding.shard_manifest(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def water(sizes: dict, weights: dict, most: float = 3) -> dict:
    total, full = sum(sizes.values()), {}
    while True:
        free = {k: w for k, w in weights.items() if k not in full}
        rest = total - sum(full.values())
        share = {k: rest * w / sum(free.values()) for k, w in free.items()}
        over = [k for k in share if share[k] > most * sizes[k] + 1e-9]
        if not over:
            return full | share
        full |= {k: most * sizes[k] for k in over}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 50, "c": 850}, {"a": 10, "b": 10, "c": 10, "d": 970}, {"a": 1, None: 999}, {"x": 5}])
def test_targets(spark, sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), (5, 2, 1), 3)
    want = water(sizes, weights)
    for r in got.collect():
        assert r.target == pytest.approx(want[r.source]) and r.weight == weights[r.source]


def corpus(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 60)), f"s{i % 4}" if i % 9 else None) for i in range(900)]
    rows += [(5, "a b c", "s1")] * 200 + [(None, "x y", "s0"), (950, None, "s2"), (951, "", "s2")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), len(rows)


@pytest.mark.parametrize("fan", [128, 8])
def test_mix_meets_targets(spark, fan):
    docs, n = corpus(spark)
    got = mixing.mix_manifest(docs, fan=fan)
    rows = got.collect()
    assert len(rows) == n and all(0 <= r.taken <= 3 * r.size for r in rows)
    by = {}
    for r in rows:
        x = by.setdefault(r.source, [0, r.target, r.source_size, 0])
        x[0], x[3] = x[0] + r.taken, x[3] + r.size
    for taken, target, source_size, size in by.values():
        assert size == source_size and abs(taken - target) <= 60
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_manifest(docs, fan=fan).collect()))


def test_mix_repeats_rows(spark):
    docs, _ = corpus(spark)
    copies = mixing.mix_manifest(docs).agg(F.sum("copies")).first()[0]
    more = docs.withColumn("copies", F.lit("own")).withColumn("nth", F.lit(7))
    mixed = mixing.mix(more)
    assert mixed.columns == more.columns and mixed.where("copies = 'own' and nth = 7").count() == copies
    assert mixing.mix(docs.limit(0)).count() == 0


def test_rounding_keeps_the_expected_mass(spark):
    units = spark.createDataFrame([("s", 0, i, float(1 + i % 5), (1 + i % 5) * 0.3, i / 50, (i * 37 % 101) / 101) for i in range(50)], "source string, chunk long, unit long, size double, mass double, place double, chance double")
    r = mixing._round_chunks(units, "bigint").first()
    size = {i: 1 + i % 5 for i in range(50)}
    assert len(r.done) == 49
    assert sum(size[d.unit] * d.up for d in r.done) + r.mass == pytest.approx(sum(s * 0.3 for s in size.values()))


def test_each_document_is_taken_as_often_as_its_probability_says(spark):
    # Some hundred sources of the same make: their draws are independent, so each place in a source has a frequency.
    words = [200, *[20] * 6, *[2] * 33]
    rows = [(s * 100 + i, "w " * n, f"s{s:04d}") for s in range(600) for i, n in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_manifest(docs, fan=16).collect()
    taken = {}
    for r in got:
        taken.setdefault((round(r.target / r.source_size, 6), r.doc_id % 100), []).append(r.copies)
    ratios = {k for k, _ in taken}
    assert len(ratios) == 3 and all(0.05 < k % 1 < 0.95 for k in ratios)
    off = []
    for (ratio, i), copies in taken.items():
        p, n = ratio % 1, len(copies)
        assert n == 200 and set(copies) <= {int(ratio), int(ratio) + 1}
        off.append((sum(copies) / n - ratio) / (p * (1 - p) / n) ** 0.5)
    # 120 frequencies: beyond 3 standard errors by chance one in 370, beyond 4.5 one in 150,000
    assert max(map(abs, off)) < 4.5 and sum(abs(x) > 3 for x in off) <= 2


def test_no_python_in_the_plan_of_the_mix(spark, capsys):
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "c", None)], "doc_id long, text string, source string")
    mixing.mix_manifest(docs).explain()
    mixing.mix(docs).explain()
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_mix_of_text_ids(spark):
    docs = spark.createDataFrame([(f"d{i}", "a b c", f"s{i % 2}") for i in range(40)], "doc_id string, text string, source string")
    assert mixing.mix_manifest(docs).count() == 40 and mixing.mix(docs).columns == docs.columns


def test_rows_are_numbered_in_steps(spark):
    from rostra.llm.common import numbered

    df = spark.createDataFrame([("a", 5, 7), ("b", 0, 3), ("c", 2, 0)], "k string, first long, n long")
    got = sorted((x.k, x.at) for x in numbered(df, "first", "n", "at", step=3).collect())
    assert got == [("a", 5 + i) for i in range(7)] + [("b", i) for i in range(3)]

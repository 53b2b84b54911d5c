from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
import xxhash

from rostra.llm import simhash
from rostra.llm.components import connected_components


def plain_fingerprint(text: str, n: int) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", ["", "one", "a b c", "a b c d", "A b\tC d\ne f É g", "x " * 500, "u v w x y z"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text, 4)


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_masks_cover_every_pair_of_bits_within_the_radius(radius):
    masks = simhash.covering_masks(radius)
    r = random.Random(1)
    some = [r.sample(range(64), radius) for _ in range(3000)] if radius > 2 else itertools.combinations(range(64), radius)
    for bits in some:
        differ = np.uint64(sum(1 << b for b in bits))
        assert any((masks & differ) == 0)


def groups(points: list[int], radius: int) -> list[int]:
    label = list(range(len(points)))
    for i, j in itertools.combinations(range(len(points)), 2):
        if (points[i] ^ points[j]).bit_count() <= radius and label[i] != label[j]:
            old, new = max(label[i], label[j]), min(label[i], label[j])
            label = [new if x == old else x for x in label]
    return label


@pytest.mark.parametrize("most", [4096, 8])
def test_links_join_what_is_near(spark, most):
    r = random.Random(2)
    centres = [r.getrandbits(64) for _ in range(6)]
    points = sorted({c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5))) for c in centres for _ in range(30)} | {r.getrandbits(64) for _ in range(50)})
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    df = spark.createDataFrame([(p, p, 0) for p in signed], "node long, fp long, check long")
    part = {x.node: x.part for x in simhash.covering_parts(df, ["fp"], 4, most=most).collect()}
    mine = {}
    for p, g in zip(signed, groups(points, 4)):
        mine.setdefault(g, set()).add(part.get(p, p))
    assert all(len(x) == 1 for x in mine.values()) and len({next(iter(x)) for x in mine.values()}) == len(mine)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in connected_components(links).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[101] == 100


def test_components_of_few_links_take_few_jobs(spark):
    r, sc = random.Random(3), spark.sparkContext
    rows = [(i, i + 1) for i in range(300)] + [(r.randrange(1000, 3000), r.randrange(-9, 3000)) for _ in range(900)] + [(7, 7), (None, 5), (5, None), (301, 300)]
    links = spark.createDataFrame(rows, "a long, b long")
    sc.setJobGroup("few links", "")
    try:
        found = connected_components(links)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("few links")) <= 5
    got = sorted(map(tuple, found.collect()))
    assert got == sorted(map(tuple, connected_components(links, few=0).collect()))
    assert len({node for node, _ in got}) == len(got) and {c for n, c in got if 0 <= n <= 301} <= {0, min(c for n, c in got if n == 0)}


def test_components_without_links(spark):
    none = spark.createDataFrame([(4, 4), (None, 1)], "a long, b long")
    assert connected_components(none).collect() == connected_components(none, few=0).collect() == []


def test_groups_handle_nulls_repeats_and_other_columns(spark):
    rows = [(3, None, "a"), (1, "", "b"), (2, "same words here again and", "c"), (5, "same words here again and", "c"), (5, "same words here again and", "c"), (None, "alone in the world of text", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.simhash_groups(docs).collect())
    assert got == [(-1, -1), (1, 1), (2, 2), (3, 1), (5, 2), (5, 2)]
    assert simhash.simhash_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_keep_one_of_near_copies(spark):
    r = random.Random(3)
    text = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(n))
    base, other = text(300), text(300)
    near = base.split()
    near[150] = "changed"
    rows = [(7, base, 1), (4, " ".join(near), 2), (9, other, 3), (9, other, 3), (8, text(5), 4)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, text_hash int"))
    assert kept.columns == ["doc_id", "text", "text_hash"] and {x.text_hash for x in kept.collect()} == {2, 3, 4}
    assert sorted(x.doc_id for x in kept.collect()) == [4, 8, 9]


def shingles(text: str) -> set[str]:
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def jaccard(a: str, b: str) -> float:
    return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))


def edited(text: str, *places: int) -> str:
    return " ".join(f"{w}x" if i in places else w for i, w in enumerate(text.split()))


@pytest.mark.parametrize("blocks", [{}, {"most": 3}])
def test_keep_one_links_by_the_similarity_of_shingles(spark, blocks):
    r = random.Random(4)
    base = [" ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(300)) for _ in range(12)]
    far = [(a, edited(a, *range(20, 20 + 9 * 25, 25))) for a in base]
    far = [(a, b) for a, b in far if min(np.bitwise_count(simhash.word_fingerprints(a, 4) ^ simhash.word_fingerprints(b, 4))) <= 4 and (simhash.fingerprint(a, 5) ^ simhash.fingerprint(b, 5)).bit_count() <= 18]
    assert len(far) > 2 and all(0.6 < jaccard(a, b) < 0.8 for a, b in far)
    # each of a chain is near the next only, and both ends of one are far
    chain = [edited(base[0], *range(20, 20 + 25 * k, 25)) for k in range(9)]
    assert all(jaccard(a, b) >= 0.8 for a, b in zip(chain, chain[1:])) and jaccard(chain[0], chain[-1]) < 0.8
    texts = [t for pair in far if pair[0] != base[0] for t in pair]
    rows = [*enumerate(texts), *enumerate(chain, 100), (200, chain[4].upper()), (201, None), (202, " ")]
    got = {x.doc_id for x in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), **blocks).collect()}
    assert got == {*range(len(texts)), 100, 201}


def test_a_large_group_of_near_copies_gives_few_links(spark, monkeypatch):
    r = random.Random(12)
    base = r.getrandbits(64)
    points = sorted({base ^ sum(1 << b for b in r.sample(range(64), 2)) for _ in range(4000)})
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    seen, plain = [], simhash.connected_components
    monkeypatch.setattr(simhash, "connected_components", lambda links: seen.append(links.count()) or plain(links))
    df = spark.createDataFrame([(p, p, ~p, 0) for p in signed], "node long, fp long, other long, check long")
    assert simhash.covering_parts(df, ["fp", "other"], 4, most=500).select("part").distinct().count() == 1
    assert seen[0] <= 5 * len(points) and seen[-1] == 0


def test_near_links_against_brute_force():
    r = random.Random(6)
    some = [frozenset(r.sample(range(40), r.randint(0, 30))) for _ in range(30)]
    sets = [s | {1000 + x for x in r.sample(range(3), 1)} for s in some for _ in range(4)]
    for least in (0.5, 0.8, 1.0):
        label = list(range(len(sets)))
        for i, j in itertools.combinations(range(len(sets)), 2):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= least:
                label = [label[i] if x == label[j] else x for x in label]
        got = list(range(len(sets)))
        for i, j in simhash.near_links([np.array(sorted(s), np.uint64) for s in sets], least):
            got[j] = i
        assert [got.index(x) for x in got] == [label.index(x) for x in label]

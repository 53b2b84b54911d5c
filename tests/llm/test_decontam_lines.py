from __future__ import annotations

import random

import numpy as np
import pytest

from rostra.llm import decontam, linededup


def edit_distance(a, b) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_banded_distance_against_all_parts():
    r = random.Random(1)
    for _ in range(60):
        a = bytes(r.choice(b"abc") for _ in range(r.randint(1, 9)))
        b = bytes(r.choice(b"abc") for _ in range(r.randint(0, 14)))
        best = min(edit_distance(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        got = decontam.banded_distance(np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8), len(a))
        assert got[0] == best


def edited(text: str, k: int, r: random.Random) -> str:
    s = list(text)
    for _ in range(k):
        at = r.randrange(len(s))
        kind = r.random()
        if kind < 0.4:
            s[at] = "#"
        elif kind < 0.7:
            del s[at]
        else:
            s.insert(at, "#")
    return "".join(s)


def corpus():
    r = random.Random(4)
    text = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n))
    items = [(i, text(30)) for i in range(12)]
    docs, held = [], {}
    for i, item in items:
        k = int(0.1 * len(item))
        k = r.randint(0, min(k, (len(item) - 8) // 8))
        docs.append((i, text(60) + " " + edited(item, k, r).upper().replace(" ", "\n ") + " " + text(40)))
        held[i] = i
    docs += [(100 + j, text(80)) for j in range(10)] + [(200, items[0][1][: len(items[0][1]) // 2]), (201, None), (202, "")]
    return items, docs, held


def test_every_item_within_the_budget_is_found(spark):
    items, docs, held = corpus()
    d = spark.createDataFrame([(*x, "z") for x in docs], "doc_id long, text string, hits string")
    b = spark.createDataFrame(items + [(99, None), (98, "tiny")], "item_id long, text string")
    got = decontam.benchmark_hits(d, b).collect()
    assert {(r.doc_id, r.item_id) for r in got} == set(held.items())
    many = decontam.benchmark_hits(d, b, block=900).collect()  # a pass for each few items
    assert sorted(many) == sorted(got)
    kept = decontam.decontaminate(d, b)
    assert kept.columns == ["doc_id", "text", "hits"] and {r.doc_id for r in kept.collect()} == {x[0] for x in docs} - set(held)


def best_distance(item: bytes, text: bytes) -> int:
    """Least edit distance of item to any part of text, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


@pytest.mark.parametrize("most", [1 << 21, 50])
def test_against_an_exhaustive_search(monkeypatch, most):
    monkeypatch.setattr(decontam, "_MOST", most)
    r = random.Random(17)
    text = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    items = [(i, text(letters, r.randint(20, 90))) for i, letters in enumerate(["ab", "ab", "abcdef", "abcdef", "abcdefgh ", "abcdefgh ", "a", "abc", "abcd", "abcdefghijkl"])]
    items += [(20, items[4][1]), (21, "ab" * 30), (22, "abc" * 15)]
    index = decontam.GramIndex(items, 0.1)
    texts = [text("abcdefgh ", 150), text("ab", 300), "a" * 200, "ab" * 100, ""]
    for _, item in items:
        budget = max(0, min(len(item) // 10, (len(item) - 8) // 8))
        texts += [text("abcdefgh ", r.randint(0, 60)) + edited(item, k, r) + text("abcdefgh ", r.randint(0, 60)) for k in (0, budget, budget + 1, 2 * budget + 1)]
    plain = [decontam._plain(t) for t in texts]
    got = [{i for i, *_ in hits} for hits in index.scan(plain)]
    for t, hits in zip(plain, got):
        assert hits == {i for (i, body), k in zip(index.items, index.budget) if len(t) and best_distance(body.tobytes(), t) <= k}


def test_texts_of_one_letter_take_bounded_memory():
    import resource

    index = decontam.GramIndex([(1, "a" * 2000), (2, "ab" * 900)], 0.1)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    [hits] = index.scan([b"a" * 20_000 + b"x"])
    assert {i for i, *_ in hits} == {1} and sum(e - s for _, s, e, _ in hits) >= 18_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000  # kB


def test_no_benchmark_and_no_documents(spark):
    d = spark.createDataFrame([(1, "a text")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.decontaminate(d, none).count() == 1
    assert decontam.decontaminate(d.limit(0), none).count() == 0


def plain_lines(docs: list[tuple], least: int = 5):
    order = sorted((("" if d is None else f"{d:09d}", t or "", d) for d, t in set(docs)))
    seen, out = [], {}
    for _, t, d in order:
        for n, line in enumerate(t.encode().split(b"\n")):
            w = line.split()
            if w:
                if w in seen:
                    out[d, t, n] = "copy"
                    continue
                if any(max(len(w), len(o)) >= least and edit_distance(w, o) <= 1 for o in seen if abs(len(w) - len(o)) < 2):
                    out[d, t, n] = "near"
                seen.append(w)
    return out


def test_lines_against_brute_force(spark):
    r = random.Random(6)
    word = lambda: r.choice("abcdefghijklmnop") * r.randint(1, 3)
    lines = [[word() for _ in range(r.choice([3, 4, 5, 6, 9, 25]))] for _ in range(60)]
    for w in lines[:45]:
        v = list(w)
        at = r.randrange(len(v))
        [lambda: v.__setitem__(at, "new"), lambda: v.pop(at), lambda: v.insert(at, "new")][r.randrange(3)]()
        lines.append(v)
    r.shuffle(lines)
    docs = [(i, "\n".join(" ".join(w) for w in lines[i * 5 : i * 5 + 5]) + "\n \n") for i in range(21)]
    docs += [(30, docs[0][1] + docs[3][1]), (31, None), (32, ""), (32, ""), (2, docs[2][1]), (None, "\n".join(" ".join(w) for w in lines[7:9]))]
    d = spark.createDataFrame([(*x, 0) for x in docs], "doc_id long, text string, line int")
    want = plain_lines(docs)
    got = linededup.dedup_lines(d).collect()
    assert len(got) == len(docs)
    for x in got:
        t = next(t for i, t in docs if i == x.doc_id)
        mine = {n: k for (i, u, n), k in want.items() if (i, u) == (x.doc_id, t or "")}
        assert (x.n_copies, x.n_near) == (sum(k == "copy" for k in mine.values()), sum(k == "near" for k in mine.values()))
        assert x.text == (None if t is None else "\n".join(s for n, s in enumerate(t.split("\n")) if n not in mine))


@pytest.mark.parametrize(("a", "b", "near"), [("a b c", "a c", True), ("a b", "b a", False), ("", "a", True), ("a b c", "a x c", True), ("a b c d", "a x c y", False)])
def test_within_one(a, b, near):
    assert linededup.within_one(a.encode().split(), b.encode().split()) is near


def test_a_text_of_very_many_lines_and_an_empty_table(spark):
    text = "\n".join(["the same line again"] * 60_000 + [f"line of some words number {i % 20_000}" for i in range(60_000)])
    d = spark.createDataFrame([(1, text, "x")], "doc_id long, text string, lines string")
    [got] = linededup.dedup_lines(d).collect()
    assert (got.n_lines, got.n_copies, got.n_near) == (120_000, 59_999 + 40_000, 19_999) and got.text == "the same line again\nline of some words number 0"
    assert linededup.dedup_lines(d.limit(0)).count() == 0

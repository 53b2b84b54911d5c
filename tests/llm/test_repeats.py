from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from rostra.llm import repeats


def expected(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


def corpus() -> list[str | None]:
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(90)
    docs: list[str | None] = [text(r.randint(5, 200)) for _ in range(20)]
    docs += [text(40) + passage + text(30) for _ in range(8)]
    docs += [passage[:250], passage[20:], docs[0], docs[3][: len(docs[3]) // 2] + "x" + docs[3][len(docs[3]) // 2 :], "ab" * 600, "q" * 700, "z" * 200, "y" * 201, "", None, None, "short", text(3000)]
    return docs


@pytest.mark.parametrize("most", [2000, 3])
def test_against_brute_force(spark, monkeypatch, most):
    scan = repeats.maximal_repeats
    monkeypatch.setattr(repeats, "maximal_repeats", lambda docs, length: scan(docs, length, most))
    texts = corpus()
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, key double")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs).collect()}
    assert [got[i] for i in range(len(texts))] == expected(texts, 200)


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_intervals_are_those_of_the_tree():
    # suffixes of "banana" in order: a, ana, anana, banana, na, nana
    assert sorted(repeats.intervals([0, 1, 3, 0, 0, 2])) == [(0, 0, 5), (1, 0, 2), (2, 4, 5), (3, 1, 2)]


def test_occurrences_have_equal_bytes(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts) if t], "key long, text string")
    by = {}
    for r in repeats.maximal_repeats(docs).collect():
        by.setdefault(r.repeat, set()).add(texts[r.key].encode()[r.start : r.end])
    assert by and all(len(x) == 1 for x in by.values())


@pytest.mark.parametrize("most", [2000, 1])
def test_long_texts_in_parts_against_brute_force(spark, monkeypatch, most):
    part, scan = 6000, repeats.maximal_repeats
    monkeypatch.setattr(repeats, "maximal_repeats", lambda docs, length: scan(docs, length, most, part))
    r = random.Random(8)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage = text(500)
    over = text(part - 250) + passage + text(part)  # a repeat across a border
    texts = [text(4 * part), text(part), text(part + 199), text(part + 200), over, text(100) + passage + text(50), "ab" * part, text(part // 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in repeats.remove_repeats(docs).collect()}
    assert [got[i] for i in range(len(texts))] == expected(texts, 200)
    assert got[0][1] == 0 and got[4][1] >= 500


def test_a_passage_among_many_texts_is_divided(spark, monkeypatch):
    scan, made = repeats.maximal_repeats, []
    monkeypatch.setattr(repeats, "maximal_repeats", lambda docs, length: made.append(scan(docs, length, 50)) or made[-1])
    r = random.Random(13)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage = text(420)
    texts = [text(r.randint(0, 300)) + passage + text(r.randint(0, 300)) for _ in range(400)] + [text(50) + passage[60:330] + text(90) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in repeats.remove_repeats(docs).collect()}
    assert [got[i] for i in range(len(texts))] == expected(texts, 200)
    assert made[0].count() < 40 * len(texts)

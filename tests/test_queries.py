"""Every registered query of the library against DuckDB, over the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from rostra.plans import catalog

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.is_dir(), reason="the fixture tables are not here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in SF.glob("*.parquet"):
        c.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if hasattr(v, "as_tuple"):
        return round(float(v), 6)
    return v


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_equals_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, str(SF))
    rel = duck.sql(catalog.ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    mine = sorted((tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    at = [rel.columns.index(c) for c in sorted(rel.columns)]
    theirs = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert mine == theirs


def test_files_are_hashed_whole(spark):
    import hashlib

    got = {Path(r.path).name: r.content_hash for r in catalog.QUERIES["a06_binary_scan"](spark, str(SF)).collect()}
    assert got == {f.name: hashlib.sha256(f.read_bytes()).hexdigest() for f in SF.glob("*.parquet")}


def test_embeddings_are_those_of_the_tokens(spark):
    from rostra.fixtures import speeches
    from rostra.functions.text import retrieval_tokens
    from rostra.operators.scoring import hash_embedding
    from pyspark.sql import functions as F

    want = {(r[0], r[1]): hash_embedding(" ".join(r[2])) for r in speeches(spark, str(SF)).select("session_id", "speech_index", retrieval_tokens(F.col("text"))).collect()}
    rows = catalog.QUERIES["x06_embed"](spark, str(SF)).collect()
    assert len(rows) == len(want) and all(r.embedding == want[r.session_id, r.speech_index] for r in rows)
    assert all(abs(sum(x * x for x in r.embedding) - 1) < 1e-9 for r in rows)


def test_answers_are_unwrapped_or_kept_apart(spark):
    rows = catalog.QUERIES["f27_coerce"](spark, str(SF)).collect()
    want = {0: '[{"a": 1}]', 1: None, 2: '[{"speech_index": 1, "final_label": "neutral"}]'}
    assert len(rows) == 200 and all(r.results == want[r.doc_id % 3] for r in rows)
    apart = catalog.QUERIES["b15_quarantine"](spark, str(SF)).collect()
    assert {r.doc_id for r in apart} == {r.doc_id for r in rows if r.doc_id % 3 == 1} and all(r.answer == "not json" for r in apart)


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "level" in df.columns


def test_no_query_of_the_library_needs_python_workers(spark):
    needs = {"x06_embed", "f27_coerce", "b15_quarantine", "r09_three_layer", "r10_one_pass", "r11_classify", "x03_extract_topics", "x04_session_topics"}
    for name, q in catalog.QUERIES.items():
        if name not in needs:
            plan = q(spark, str(SF))._jdf.queryExecution().optimizedPlan().toString()
            assert "Python" not in plan and "Pandas" not in plan, name


def test_overlap_reads_words_like_the_sql(spark, tmp_path):
    # Sharp and long s end a word, marks of any script do not, and a null text has null counts.
    texts = ["große Straße ist groß und fuß an fuß", "ſo iſt es", "ab́c a֑b ab࢘c Å̧ K ǆ ﬁn", "İstanbul ÉTÉ étè été", "", "!!", None]
    spark.createDataFrame(list(enumerate(texts * 2)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW benchmark AS SELECT * FROM '{tmp_path}/benchmark.parquet/*.parquet'")
    got = catalog.QUERIES["d12_overlap"](spark, str(tmp_path)).select("item_id", "tp", "fp", "fn").collect()
    assert sorted(map(tuple, got)) == sorted(duck.sql(catalog.ORACLE["d12_overlap"]).fetchall())

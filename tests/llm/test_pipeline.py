from __future__ import annotations

import random

import pytest

import corpus_pipeline
from rostra.llm.common import cut
from rostra.llm.sharding import jump_hash, stable_key


def test_stages(spark, tmp_path):
    r = random.Random(11)
    text = lambda n: " ".join("".join(r.choice("abcdefghijk") for _ in range(r.randint(2, 8))) for _ in range(n))
    bench = [(i, text(30)) for i in range(5)]
    rows, toxic = [], {}
    for i in range(240):
        toxic[i] = int(i % 6 == 0)
        rows.append((i, text(80) + (" vilest grubby vilesome " if toxic[i] else " ") + text(20)))
    rows += [(1000 + i, rows[i * 6 + 1][1]) for i in range(10)] + [(2000 + i, text(20) + " " + b + " " + text(20)) for i, b in bench]
    near = rows[7][1].split()
    near[40] = "other"
    rows += [(3000, " ".join(near)), (3001, None), (3002, "")]
    docs = spark.createDataFrame([(d, t, "en", f"s{d % 3}", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, 1, t) for d, t in toxic.items()], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    kept, columns = {}, docs.columns
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        at = cut(stage(spark, at, str(tmp_path)))
        kept[name] = [x.doc_id for x in at.select("doc_id").collect()]
        if name != "sharding":
            assert at.columns == columns
    bad = {d for d, t in toxic.items() if t}
    assert set(kept["toxicity"]) == {d for d, _ in rows} - bad
    assert set(kept["simhash near-dedup"]) == set(kept["toxicity"]) - set(range(1000, 1010)) - {3000, 3002}
    assert set(kept["decontamination"]) == set(kept["simhash near-dedup"]) - {2000 + i for i, _ in bench}
    assert set(kept["mixing"]) <= set(kept["decontamination"]) and max(map(kept["mixing"].count, kept["mixing"])) <= 3
    import pandas as pd

    assert all(x.shard == jump_hash(stable_key(pd.Series([str(x.doc_id)])), 24)[0] for x in at.collect())
    assert sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(str, at.collect()))


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, toxicity string, hits string, text_hash string, copies long, nth long, words string, part string"


def tables_at(spark, path, rows):
    docs = spark.createDataFrame(rows, COLUMNS)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 1), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(None, "an item of the benchmark, long enough"), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return docs


@pytest.mark.parametrize("stage", range(5))
def test_a_stage_leaves_an_empty_table_empty(spark, tmp_path, stage):
    docs = tables_at(spark, tmp_path, [])
    got = corpus_pipeline.STAGES[stage][1](spark, docs, str(tmp_path))
    assert got.count() == 0 and set(docs.columns) <= set(got.columns)


def test_nulls_repeats_long_texts_and_clashing_columns(spark, tmp_path):
    r = random.Random(12)
    text = lambda n: " ".join("".join(r.choice("abcdefghijk") for _ in range(r.randint(2, 8))) for _ in range(n))
    more = ("tox", "hit", "hash", 7, 8, "w", "p")
    rows = [(i, text(40), None, "s", None, *more) for i in range(1, 20)]
    rows += [(None, text(30), "en", None, 3, *more), (None, None, None, None, None, *[None] * 7), (30, "", "en", "s", 0, *more), (31, None, "en", "s", 0, *more), rows[4], rows[4], (40, text(60_000), "en", "s", 1, *more)]
    docs = tables_at(spark, tmp_path, rows)
    at, kept = docs, []
    for name, stage in corpus_pipeline.STAGES:
        at = cut(stage(spark, at, str(tmp_path)))
        kept.append(at.count())
        assert at.columns == docs.columns + (["shard"] if name == "sharding" else [])
        assert at.where("text is not null and toxicity = 'tox' and hits = 'hit' and text_hash = 'hash' and copies = 7 and nth = 8 and words = 'w' and part = 'p'").count() == at.where("text is not null").count()
    # the two repeats and two of the three texts without a word go
    assert kept[:3] == [len(rows), len(rows) - 4, len(rows) - 4]
    assert at.where("doc_id = 40").count() >= 1


def test_a_cut_leaves_no_shuffle_files(spark):
    import time
    from pathlib import Path

    from pyspark.sql import functions as F

    from rostra.llm.common import CLEANUP, cut

    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    found = lambda: {f for d in env.blockManager().diskBlockManager().localDirsString() for f in Path(d).rglob("shuffle_*.data")}
    before, was = found(), spark.conf.get(CLEANUP)
    held = cut(spark.range(20000).groupBy((F.col("id") % 5000).alias("k")).count())
    for _ in range(20):  # they go in the background
        if not found() - before:
            break
        time.sleep(0.25)
    assert not found() - before and spark.conf.get(CLEANUP) == was
    assert held.count() == 5000


def test_a_cut_leaves_no_list_of_files_with_the_driver(spark):
    from rostra.llm.common import LISTS, cut

    def held(x, name):
        field = next(f for f in x.getClass().getDeclaredFields() if f.getName().endswith(name))
        field.setAccessible(True)
        return field.get(x)

    def lists() -> int:
        kind = spark.sparkContext._jvm.java.lang.Class.forName("org.apache.spark.sql.execution.datasources.FileStatusCache$")
        shared = held(kind.getField("MODULE$").get(None), "sharedCache")
        return held(shared, "$cache").size() if shared else 0

    before, was = lists(), spark.conf.get(LISTS)
    assert sum(cut(spark.range(100).repartition(4)).count() for _ in range(3)) == 300
    assert lists() == before and spark.conf.get(LISTS) == was

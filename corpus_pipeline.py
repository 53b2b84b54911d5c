"""From raw documents to training shards: five stages, each on all that its predecessor kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.llm.common import crc_fold, cut, fresh, table
from rostra.llm.decontam import decontaminate
from rostra.llm.mixing import mix
from rostra.llm.sharding import with_shard
from rostra.llm.simhash import keep_one
from rostra.llm.toxicity import fit, with_toxicity


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; the classifier learns from the labelled ones of two folds in three.

    Null and empty texts get the score of the share of toxic labels, and stay as long as that is below 0.7; long
    texts are scored whole; repeated rows and null ids are judged each; an empty table stays empty; columns stay,
    also one called toxicity.
    """
    labels = table(spark, sf_dir, "labels")
    index = fit(docs, labels.where(crc_fold(labels["doc_id"], 3) != 1))
    found = fresh(docs, "toxicity")
    return with_toxicity(docs, index, into=found).where(F.col(found)["predicted"] == 0).drop(found)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles with a Jaccard of 0.8 or more.

    It is that of the least doc_id, a null one last, then of the least text hash; of repeated rows one stays. Texts
    without a word, null or empty, are one group; long texts count whole; an empty table stays empty; columns stay,
    whatever their names.
    """
    return keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within a tenth of its length in edits go.

    Null and empty texts hold none; long texts are searched whole; repeated rows and null ids are judged each; an
    empty table or benchmark changes nothing; columns stay, also one called hits.
    """
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, three times at most.

    Null and empty texts have size 0 and are taken by whole parts of their source's rate alone; a null source is
    one source, the last; rows alike in source, id and size share their copies evenly; an empty table stays empty;
    columns stay, whatever their names.
    """
    return mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with the shard, of 24, that their doc_id falls to.

    Rows with the same id, so also copies of a row, are in one shard, null ids in that of the empty text; texts
    don't matter; an empty table stays empty; a column called shard is replaced.
    """
    return with_shard(docs, 24)


STAGES = [
    ("toxicity", without_toxic),
    ("simhash near-dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: The classifier and the fingerprints have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder and read again."""
    return reduce(lambda docs, stage: cut(stage[1](spark, docs, sf_dir)), STAGES, table(spark, sf_dir, "documents"))

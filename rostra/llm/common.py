"""Helpers shared by the corpus operators: reading, durable cuts of lineage, text classes."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from typing import Any

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import rostra

# What runs on executors travels with its code: they need this package's requirements, not the package.
cloudpickle.register_pickle_by_value(rostra)

#: A word is a run of bytes other than space and the ASCII controls 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of a batch that goes to Python: batches of a fixed number of long texts would be of any size.
BATCH = 4 << 20


#: Whether a query's shuffle files are deleted as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Whether the driver keeps the list of a folder's files, up to 250 MB of such lists, until the JVM ends.
LISTS = "spark.sql.hive.manageFilesourcePartitions"


def bounded(spark: SparkSession) -> None:
    """Bounds the batches that Spark sends to Python by their bytes, unless the session sets a bound of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, str(BATCH))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only in local mode, where there are no others, one is made if that is unset."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="rostra-"))
        named = sc.getCheckpointDir()
    return named


def cut(df: DataFrame) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back, so that lost executors cost no recomputation.

    The files are deleted when released() is called, or when the driver's JVM ends. What the executors shuffled
    for them goes at once, not when the driver happens to collect its garbage; the list of the files goes with the
    frame.
    """
    spark = df.sparkSession
    bounded(spark)
    path = f"{shared_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    with _set(spark, CLEANUP, "true"):
        df.write.parquet(path)
    _at(spark, path, "deleteOnExit")
    with _set(spark, LISTS, "false"):
        again = spark.read.schema(df.schema).parquet(path)
    again._cut_path = path
    return again


@contextlib.contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _at(spark: SparkSession, path: str, what: str, *more) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    getattr(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), what)(at, *more)


def released(*frames: DataFrame | None) -> None:
    """Deletes the files of frames that cut() gave and that nothing will read any more."""
    for df in frames:
        if path := getattr(df, "_cut_path", None):
            _at(df.sparkSession, path, "delete", True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like `name` that df doesn't have, in any case of letters."""
    taken_names = {c.lower() for c in df.columns}
    while name.lower() in taken_names:
        name = f"_{name}"
    return name


def numbered(df: DataFrame, first: str, n: str, into: str, step: int = 1 << 16) -> DataFrame:
    """df with each row as often as its column n says, numbered from its column `first` on; no array is longer than `step`."""
    at, one = fresh(df, "from_here"), fresh(df, "nth_here")
    parts = df.where(F.col(n) > 0).withColumn(at, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(step).cast("long"))))
    each = parts.withColumn(one, F.explode(F.sequence(F.col(at), F.least(F.col(at) + step, F.col(n)) - 1)))
    return each.withColumn(into, F.col(first) + F.col(one)).drop(at, one)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(folds)


def share(spark: SparkSession, value: Any) -> Broadcast:
    """A broadcast of any object of bounded size; taken() reads it on executors."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def taken(shared: Broadcast) -> Any:
    return cloudpickle.loads(shared.value)

"""New and changed transcripts, processed once each: a file stream with a ledger of content hashes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rostra.operators.state import candidates, upsert

FILE = "path string, modificationTime timestamp, length bigint, content binary"
LEDGER = "path string, content_hash string"


def process_new(spark: SparkSession, folder: str, ledger: str, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """handle(files, batch) for the files of `folder` that are new or changed, then the ledger is renewed.

    A batch of the stream names the files that have arrived; the ledger, a folder of Parquet with a version a
    batch, says which of them have other content than before. The ledger is written after handle() has come
    back, so a batch that failed is handled again; handle() must bear that, as upserts do.
    """
    stream = spark.readStream.format("binaryFile").schema(FILE).load(folder)

    def each(batch: DataFrame, number: int) -> None:
        old = read_ledger(spark, ledger)
        files = batch.select("path", F.sha2("content", 256).alias("content_hash"))
        found = candidates(files, old)
        handle(found, number)
        upsert(old, found.select("path", "content_hash"), ["path"]).write.mode("overwrite").parquet(f"{ledger}/version={number}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The latest version of a ledger; empty before the first batch."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    versions = sorted(int(x.getPath().getName().split("=")[1]) for x in fs.listStatus(path) if x.getPath().getName().startswith("version=")) if fs.exists(path) else []
    if not versions:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{ledger}/version={versions[-1]}")


def live_counts(speeches: DataFrame, late: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Speeches by window and label from a stream with a `spoken_at` time; late ones count until the watermark."""
    return speeches.withWatermark("spoken_at", late).groupBy(F.window("spoken_at", window), "label").agg(F.count("*").alias("speeches"))

"""State tables: their types, additive migrations, scans, and an index of embedded chunks that is kept by content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from rostra.operators import chunks as C
from rostra.operators import scoring, state

# The state tables with their columns, and what a column that came later starts with.
STATE = {
    "metadata": "key string, value string",
    "runs": "run_id string, started_at string, finished_at string, status string, sessions_processed int, interventions_total int, interventions_classified int, unmatched_speakers int, created_at string",
    "processed_stenograms": "stenogram_path string, content_hash string, file_mtime_ns bigint, last_processed_run_id string, last_processed_at string",
    "run_outputs": "run_id string, sessions_count int, speeches_total int, summary_json string, created_at string, updated_at string",
    "members": "member_id string, source_member_id string, chamber string, name string, normalized_name string, party_id string, bills_authored_total int, amendments_added_total int, profile_url string, circumscriptie string, created_at string, updated_at string",
    "interventions_raw": "intervention_id string, run_id string, session_id string, session_date string, stenogram_path string, speech_index int, raw_speaker string, normalized_speaker string, member_id string, text string, text_hash string, created_at string, updated_at string",
    "intervention_analysis": "intervention_id string, run_id string, relevance_label string, relevance_source string, topics_json string, layer_a_json string, confidence double, evidence_chunk_ids_json string, analysis_version string, reasoning string, created_at string, updated_at string",
    "session_topics": "session_id string, run_id string, stenogram_path string, topics_json string, topics_source string, created_at string, updated_at string",
    "session_chunks": "chunk_id string, run_id string, session_id string, stenogram_path string, chunk_type string, chunk_index int, source_speech_index int, text string, tokens_json string, created_at string, updated_at string",
    "unmatched_speakers": "run_id string, session_id string, stenogram_path string, raw_speaker string, normalized_speaker string, occurrences int, created_at string, updated_at string",
}
DEFAULTS = {
    "sessions_processed": 0, "interventions_total": 0, "interventions_classified": 0, "unmatched_speakers": 0, "bills_authored_total": 0, "amendments_added_total": 0, "occurrences": 1,
    "relevance_source": "constructiveness_baseline_v1", "analysis_version": "scaffold_v1", "topics_source": "keyword_baseline_v1",
}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(STATE[name])


def migrated(rows: DataFrame, name: str) -> DataFrame:
    """Rows in the columns of a state table, cast to its types; columns that are missing get their defaults, others go."""
    have = {c.lower() for c in rows.columns}
    default = lambda f: F.lit(DEFAULTS.get(f.name)).cast(f.dataType)
    return rows.select(*[(F.coalesce(F.col(f.name).cast(f.dataType), default(f)) if f.name in have else default(f)).alias(f.name) for f in schema(name).fields])


def create_tables(spark: SparkSession, path: str) -> list[str]:
    """Writes the state tables that aren't there yet, empty; the names of those it wrote."""
    made = []
    for name in STATE:
        try:
            spark.read.parquet(f"{path}/{name}").schema  # noqa: B018
        except AnalysisException:
            spark.createDataFrame([], schema(name)).write.parquet(f"{path}/{name}")
            made.append(name)
    return made


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A state table in its present columns, whatever columns its files have."""
    return migrated(spark.read.option("mergeSchema", "true").parquet(f"{path}/{name}"), name)


def dates(text: Column) -> Column:
    """F32: the day of an ISO date or time; null if there is none."""
    return F.try_to_date(F.substring(F.trim(text), 1, 10), "yyyy-MM-dd")


def updated_index(chunks: DataFrame, index: DataFrame | None, embed=scoring.hash_embedding) -> DataFrame:
    """The index of all sessions of chunks: rows of sessions whose content is the same are taken over, others embedded anew.

    index has session_id, content_hash, chunk_id, chunk_type, source_speech_index, text, embedding, a row a chunk.
    """
    hashes = C.index_hash(chunks).select("session_id", "content_hash")
    stale = hashes if index is None else state.changed_rows(index.select("session_id", "content_hash").distinct(), hashes, ["session_id"])
    new = scoring.embedded(chunks.join(stale, "session_id"), F.col("text"), embed).select("session_id", "content_hash", "chunk_id", "chunk_type", "source_speech_index", "text", "embedding")
    return new if index is None else new.unionByName(index.join(hashes, ["session_id", "content_hash"], "left_semi"))


def write_index(index: DataFrame, path: str) -> None:
    """A folder for each session's rows."""
    index.write.mode("overwrite").partitionBy("session_id").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame | None:
    """An index, or None where there is none that can be read."""
    try:
        return spark.read.parquet(path).withColumn("session_id", F.col("session_id").cast("string"))
    except AnalysisException:
        return None

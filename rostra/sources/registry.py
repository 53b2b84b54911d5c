"""Member registries, transcripts, gold sets and lists of paths or ids from JSON and text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.functions.text import merged_text, stripped

#: The keys under which registries have given these numbers, first to last.
BILL_KEYS = ["bills_authored_total", "bills_authored", "total_bills_authored", "initiated_bills_count", "proiecte_initiate_total", "proiecte_initiate"]
AMENDMENT_KEYS = ["amendments_added_total", "amendments_added", "total_amendments_added", "amendments_count", "proposed_amendments_count", "amendamente_adaugate_total", "amendamente_adaugate"]
_MEMBER = "id string, name string, profile_url string, circumscriptie string, party string, party_full_name string"
REGISTRY = f"metadata struct<build_date:string,total_count:int>, members array<struct<{', '.join(f'{n}:{t}' for n, t in (x.rsplit(' ', 1) for x in _MEMBER.split(', ')))}, {', '.join(f'{k}:string' for k in BILL_KEYS + AMENDMENT_KEYS)}>>"
SESSION = "source_url string, session_id string, stenograma_date string, initial_notes string, speeches array<struct<speaker:string,text:string,text2:string,text3:string>>"


def source_id(own: Column, url: Column, chamber: Column, name: Column) -> Column:
    """A2: the id, else a senator's ParlamentarID in the address, else the address, else the name's SHA-1."""
    blank_null = lambda c: F.nullif(stripped(c), F.lit(""))
    return F.coalesce(blank_null(own), F.when(chamber == "senator", blank_null(F.try_parse_url(url, F.lit("QUERY"), F.lit("ParlamentarID")))), blank_null(url), F.sha1(stripped(name)))


def first_count(*values: Column) -> Column:
    """A3: the first that is an integer, 0 at least; 0 if none is."""
    return F.greatest(F.lit(0).cast("long"), F.coalesce(*[v.try_cast("long") for v in values], F.lit(0).cast("long")))


def read_registry(spark: SparkSession, path: str, chamber: str) -> DataFrame:
    """A1: one row a member, with the chamber; rows without a name or id go."""
    m = spark.read.schema(REGISTRY).json(path, multiLine=True).select(F.explode("members").alias("m")).select("m.*")
    known = m.where(stripped(F.col("name")) != "").withColumn("source_member_id", source_id(F.col("id"), F.col("profile_url"), F.lit(chamber), F.col("name")))
    return known.select(
        F.concat(F.lit(f"{chamber}_"), "source_member_id").alias("member_id"), F.lit(chamber).alias("chamber"), "source_member_id", "name", F.col("party").alias("party_id"),
        "profile_url", "circumscriptie", first_count(*[F.col(k) for k in BILL_KEYS]).alias("bills_authored_total"), first_count(*[F.col(k) for k in AMENDMENT_KEYS]).alias("amendments_added_total"),
    )


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """One row a speech, in order; a file of another shape is an error."""
    raw = spark.read.schema(SESSION).option("mode", "FAILFAST").json(path, multiLine=True)
    return raw.select(F.col("_metadata.file_path").alias("path"), "source_url", "session_id", F.to_date("stenograma_date").alias("session_date"), F.coalesce("initial_notes", F.lit("")).alias("initial_notes"),
                      F.posexplode("speeches").alias("speech_index", "s")).select("*", F.col("s.speaker").alias("raw_speaker"), merged_text(F.col("s.text"), F.col("s.text2"), F.col("s.text3")).alias("text")).drop("s")


def read_paths(spark: SparkSession, path: str) -> DataFrame:
    """A5: the paths of a selection file."""
    return spark.read.schema("files array<string>").json(path, multiLine=True).select(F.explode("files").alias("path"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids from a JSON list or one a line, each once, with its first position."""
    text = stripped(F.col("value"))
    listed = F.from_json(text, "array<string>")
    ids = F.when(text.startswith("["), listed).otherwise(F.split(text, r"\r?\n"))
    return spark.read.text(path, wholetext=True).select(F.posexplode(ids).alias("position", "id")).select("position", stripped(F.col("id")).alias("id")).where("id <> ''").groupBy("id").agg(F.min("position").alias("position"))


def read_gold(spark: SparkSession, path: str, difficulties: list[str] | None = None) -> DataFrame:
    """A10."""
    shape = "speeches array<struct<id:int,session_id:string,speech_index:int,raw_speaker:string,expected_label:string,difficulty:string,text:string,labeling_notes:string,expected_topics:array<string>,expected_law_ids:array<string>>>"
    rows = spark.read.schema(shape).json(path, multiLine=True).select(F.inline("speeches"))
    return rows if difficulties is None else rows.where(F.col("difficulty").isin(difficulties))


def gold_targets(gold: DataFrame) -> DataFrame:
    """A10: the speech indexes of each session, sorted, each once."""
    return gold.groupBy("session_id").agg(F.array_sort(F.collect_set("speech_index")).alias("indexes"))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, SHA-256 and modification time of files; the order is left to the reader of the result."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("content_hash"), F.col("modificationTime").alias("modified"))


def read_responses(spark: SparkSession, path: str, done: DataFrame | None = None) -> DataFrame:
    """Responses of other tools: the parts of the file name, and the text without a byte-order mark; done ones go."""
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.split(name, "_").alias("parts"), F.regexp_replace("value", "^﻿", "").alias("text"))
    return rows if done is None else rows.join(done, "path", "left_anti")


def session_links(sessions: DataFrame) -> DataFrame:
    """The address of each session in its last file by path, and its first file."""
    return sessions.groupBy("session_id").agg(F.max_by("source_url", "path").alias("source_url"), F.min("path").alias("first_path"))

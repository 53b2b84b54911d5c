"""A tool facade over the tables, for agents: named tools, one envelope for results and errors, and never an exception.

Reads are filters on a key, which Parquet can push down. Writes are checked one by one and gathered; flush()
upserts them in one job, as a table at a time is how a cluster writes.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.operators.chunks import hybrid
from rostra.operators.rules import LABELS
from rostra.operators.state import accumulate, upsert

TOPICS, TOPIC_LENGTH = 5, 64


class Refused(Exception):
    def __init__(self, code: str, message: str):
        super().__init__(message)
        self.code = code


def _need(ok: bool, message: str, code: str = "VALIDATION_ERROR") -> None:
    if not ok:
        raise Refused(code, message)


class Tools:
    """tables: sessions, session_topics, interventions, members, chunks, analysis, unmatched, runs; each a DataFrame with the key's column."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame]):
        self.spark, self.tables = spark, tables
        self.written: dict[str, list[dict]] = {}
        self.tools: dict[str, Callable[[dict], dict]] = {
            "get_run_config": self._config, "get_session": lambda p: {"session": self._one("sessions", "session_id", p)}, "get_session_topics": self._topics,
            "get_intervention": lambda p: {"intervention": self._one("interventions", "intervention_id", p)}, "get_member": lambda p: {"member": self._one("members", "member_id", p)},
            "get_chunk": lambda p: {"chunk": self._one("chunks", "chunk_id", p)}, "retrieve_context": self._context, "store_session_topics": self._store_topics,
            "store_intervention_analysis": self._store_analysis, "log_unmatched_speaker": self._unmatched, "finish_run": self._finish,
        }

    def call(self, name: str, params: dict[str, Any]) -> dict:
        try:
            _need(name in self.tools, f"Unknown tool: {name}", "UNSUPPORTED")
            return {"ok": True, **self.tools[name](params)}
        except Refused as e:
            return {"ok": False, "error": {"code": e.code, "message": str(e), "details": {}}}
        except Exception as e:  # the envelope is the contract
            return {"ok": False, "error": {"code": "INTERNAL_ERROR", "message": str(e), "details": {}}}

    def flush(self) -> dict[str, DataFrame]:
        """The tables with what was written; the writes are forgotten."""
        keys = {"session_topics": ["session_id"], "analysis": ["intervention_id"], "runs": ["run_id"]}
        out = {}
        for name, rows in self.written.items():
            old = self.tables[name]
            if name == "unmatched":
                by = ["session_id", "normalized_speaker"]
                new = self.spark.createDataFrame(rows, old.schema).groupBy(*by).agg(F.max("raw_speaker").alias("raw_speaker"), F.sum("occurrences").alias("occurrences"))
                out[name] = accumulate(old.select(*by, "raw_speaker", "occurrences"), new.select(*by, "raw_speaker", "occurrences"), by, "occurrences", "raw_speaker")
            else:
                last = {tuple(r[k] for k in keys[name]): r for r in rows}
                out[name] = upsert(old, self.spark.createDataFrame([tuple(r.get(f) for f in old.columns) for r in last.values()], old.schema), keys[name])
        self.tables |= out
        self.written = {}
        return out

    def _one(self, table: str, key: str, params: dict) -> dict:
        value = params.get(key)
        _need(isinstance(value, str) and bool(value), f"{key} is required")
        row = self.tables[table].where(F.col(key) == value).limit(1).collect()
        _need(bool(row), f"Not found: {value}", "NOT_FOUND")
        return row[0].asDict(recursive=True)

    def _config(self, params: dict) -> dict:
        return {"config": {"labels": LABELS, "max_topics": TOPICS, "max_topic_length": TOPIC_LENGTH, "top_k": 10}}

    def _topics(self, params: dict) -> dict:
        _need(bool(params.get("session_id")), "session_id is required")
        rows = self.tables["session_topics"].where(F.col("session_id") == params["session_id"]).limit(1).collect()
        return {"topics": rows[0].asDict(recursive=True)["topics"] if rows else []}

    def _context(self, params: dict) -> dict:
        top = params.get("top_k", 10)
        _need(isinstance(top, int) and 1 <= top <= 50, "top_k must be an integer between 1 and 50")
        one = self._one("interventions", "intervention_id", params)
        said = self.tables["interventions"].where(F.col("intervention_id") == one["intervention_id"])
        near = self.tables["chunks"].where(F.col("session_id") == one["session_id"])
        return {"chunks": [r.asDict() for r in hybrid(said, near, top).orderBy("position").collect()]}

    def _store_topics(self, params: dict) -> dict:
        _need(isinstance(params.get("topics"), list), "topics must be a list")
        self._one("sessions", "session_id", params)
        labels = [t.get("label", "") if isinstance(t, dict) else t for t in params["topics"]]
        _need(all(isinstance(x, str) and x.strip() for x in labels), "Each topic must be a string or a dict with 'label'")
        return self._write("session_topics", {"session_id": params["session_id"], "topics": list(dict.fromkeys(x.strip() for x in labels))})

    def _store_analysis(self, params: dict) -> dict:
        topics, sure = params.get("topics", []), params.get("confidence")
        _need(params.get("label") in LABELS, f"label must be one of {LABELS}")
        _need(isinstance(topics, list) and len(topics) <= TOPICS and all(isinstance(t, str) and 0 < len(t.strip()) <= TOPIC_LENGTH for t in topics), f"topics must be at most {TOPICS} strings of 1 to {TOPIC_LENGTH} characters")
        _need(isinstance(sure, (int, float)) and 0 <= sure <= 1, "confidence must be between 0.0 and 1.0")
        one = self._one("interventions", "intervention_id", params)
        ids = list(dict.fromkeys(params.get("evidence_chunk_ids", [])))
        if ids:
            known = self.tables["chunks"].where(F.col("chunk_id").isin(ids) & (F.col("session_id") == one["session_id"])).select("chunk_id").distinct().count()
            _need(known == len(ids), "evidence_chunk_ids must be chunks of the same session", "NOT_FOUND")
        return self._write("analysis", {"intervention_id": one["intervention_id"], "label": params["label"], "topics": [t.strip() for t in topics], "confidence": float(sure)})

    def _unmatched(self, params: dict) -> dict:
        for k in ("session_id", "raw_speaker", "normalized_speaker"):
            _need(bool(params.get(k)), f"{k} is required")
        return self._write("unmatched", {k: params[k] for k in ("session_id", "raw_speaker", "normalized_speaker")} | {"occurrences": 1})

    def _finish(self, params: dict) -> dict:
        _need(bool(params.get("run_id")), "run_id is required")
        return self._write("runs", {"run_id": params["run_id"], "status": params.get("status", "completed")})

    def _write(self, table: str, row: dict) -> dict:
        self.written.setdefault(table, []).append(row)
        return {"stored": True}

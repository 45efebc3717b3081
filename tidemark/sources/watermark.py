"""High-water-mark documents: lookup and write.

A table's mark lives in its own folder as an append-only log of one-line
JSON documents ``{"cdc", "run_at", "run_id"}``, one file per run named by
its write time (``cdc-<ns>.json``). Creating a new file is atomic on every
Hadoop store, so a crash can never leave the table without a mark; the
lookup reads the newest file. The document is one line, so it is written
and read with a single file-system call instead of a Spark job; the whole
log stays readable as a JSON table (``watermark_history``).
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession

from .. import fs

MARK_SCHEMA = "cdc string, run_at string, run_id string"


def _mark_files(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in fs.list_names(spark, folder) if n.startswith("cdc-") and n.endswith(".json")]


def read_watermark(spark: SparkSession, folder: str) -> str | None:
    """Latest stored mark of a table, or ``None`` when none was written yet."""
    names = _mark_files(spark, folder)
    if not names:
        return None
    text = fs.read_text(spark, f"{folder}/{max(names)}")
    return json.loads(text)["cdc"] if text else None


def write_watermark(spark: SparkSession, folder: str, cdc: str, run_at: str, run_id: str) -> None:
    """Add the new mark as a new one-line JSON file (never overwrites)."""
    doc = json.dumps({"cdc": cdc, "run_at": run_at, "run_id": run_id})
    fs.write_text(spark, f"{folder}/cdc-{time.time_ns():020d}.json", doc + "\n")


def watermark_history(spark: SparkSession, folder: str) -> DataFrame:
    """All marks ever written for a table (audit / debugging)."""
    return spark.read.schema(MARK_SCHEMA).option("recursiveFileLookup", "true").json(folder)

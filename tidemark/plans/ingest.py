"""Metadata-driven incremental ingest (source -> bronze) with a run report.

Per table and run:

1. look up the stored high-water mark (or take the backfill ``from_date``);
2. one aggregate job: rows in the window and their maximum change value;
3. if there are rows: one copy job ``low < cdc <= high`` appended to bronze,
   counted on the fly with an ``Observation`` (no second pass);
   With a look-back, rows below the mark that no earlier run delivered go with
   them; with a target schema, values that do not convert are counted, and kept
   in a side table of rejects;
4. append the new mark. Data first, mark second: a crash in between means
   the same rows are delivered again, which the gold merges absorb.

A table list is processed in order (or with a bounded thread pool); a
failing table does not stop the others, shows up as FAILED in the report,
which is the run's alert feed, and ends the run in an error.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fs
from ..config import SourceTable
from ..functions.columns import casted_to, conversions, misfits, rejected, typed_literal
from ..paths import Layout
from ..sinks.bronze import append_bronze
from ..sources.extract import incremental_extract, late_rows, window_stats
from ..sources.relational import SourceReader
from ..sources.watermark import read_watermark, write_watermark

REPORT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_at", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("low_mark", T.StringType()),
    T.StructField("watermark", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("pipeline", T.StringType()),
    T.StructField("rows_late", T.LongType()),
    T.StructField("rejected", T.MapType(T.StringType(), T.LongType())),
])

SUCCEEDED, NO_DATA, FAILED = "SUCCEEDED", "NO_DATA", "FAILED"


@dataclass(frozen=True)
class IngestResult:
    run_id: str
    run_at: str
    table_name: str
    status: str
    rows_read: int
    low_mark: str | None
    watermark: str | None
    error: str | None = None
    rows_late: int = 0                  # of rows_read: below the mark
    rejected: tuple[tuple[str, int], ...] = ()   # (column, values that did not convert)

    def as_row(self, pipeline: str) -> tuple:
        return (self.run_id, self.run_at, self.table_name, self.status, self.rows_read, self.low_mark,
                self.watermark, self.error, pipeline, self.rows_late, dict(self.rejected))


def utc_now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def ingest_table(spark: SparkSession, cfg: SourceTable, reader: SourceReader, layout: Layout,
                 *, run_id: str | None = None, run_at: str | None = None,
                 from_date: str | None = None, target_schema: T.StructType | None = None) -> IngestResult:
    """Extract the new rows of one table into bronze and advance its mark.

    ``from_date`` (or ``cfg.from_date``) replaces the stored mark as the low
    end (backfill); an empty string counts as not given. The mark is still
    moved to the window's maximum afterwards.
    """
    run_id = run_id or uuid.uuid4().hex
    run_at = run_at or utc_now()
    override = cfg.from_date if from_date is None else from_date
    stored = read_watermark(spark, layout.watermark(cfg.table))
    low = override or stored
    src = reader(cfg)
    at_source = getattr(reader, "window", None)
    stats = window_stats(src, cfg.cdc_col, low, at_source(cfg, low) if at_source else None)
    delta = incremental_extract(src, cfg.cdc_col, low, stats.high) if stats.rows else src.where("false")
    schema = target_schema if target_schema is not None else src.schema
    if cfg.lookback and stored and not override and fs.has_data_files(spark, layout.bronze(cfg.table)):
        late = _late(spark, cfg, src, stored, layout, schema)
        if stats.rows or not late.isEmpty():
            delta = delta.unionByName(late)
        elif not stats.rows:
            return IngestResult(run_id, run_at, cfg.table, NO_DATA, 0, low, stored)
    elif not stats.rows:
        return IngestResult(run_id, run_at, cfg.table, NO_DATA, 0, low, stored)
    counts = [F.count(F.lit(1)).alias("rows")]
    if cfg.lookback and stored and not override:
        counts.append(F.count_if(F.col(cfg.cdc_col) <= typed_literal(stored, src.schema[cfg.cdc_col].dataType)).alias("late"))
    lost = misfits(src, schema) if target_schema is not None else {}
    counts += [F.count_if(bad).alias(f"lost_{i}") for i, bad in enumerate(lost.values())]
    obs = Observation(f"extract_{cfg.table}_{run_id[:8]}")
    copy = delta.observe(obs, *counts)
    append_bronze(casted_to(copy, schema) if target_schema is not None else copy, layout.bronze(cfg.table))
    seen = obs.get
    refused = tuple((c, int(seen[f"lost_{i}"])) for i, c in enumerate(lost) if seen[f"lost_{i}"])
    if refused:
        write_rejects(delta, schema, cfg.table, run_id, layout)
    mark = stats.high if stats.rows else stored
    if stats.rows:
        write_watermark(spark, layout.watermark(cfg.table), mark, run_at, run_id)
    return IngestResult(run_id, run_at, cfg.table, SUCCEEDED, int(seen["rows"]), low, mark, None,
                        int(seen.get("late") or 0), refused)


def _late(spark: SparkSession, cfg: SourceTable, src: DataFrame, mark: str, layout: Layout, schema: T.StructType) -> DataFrame:
    """Source rows of the look-back window that bronze does not hold, compared in the
    form in which bronze holds them."""
    form = conversions(src, schema)
    delivered = spark.read.schema(casted_to(src.limit(0), schema).schema).parquet(layout.bronze(cfg.table))
    return late_rows(src, delivered, cfg.cdc_col, mark, cfg.lookback, form)


def write_rejects(delta: DataFrame, schema: T.StructType, table_name: str, run_id: str, layout: Layout) -> None:
    """Append the values of a run that did not convert to the table's rejects."""
    (rejected(delta, schema).select(F.lit(run_id).alias("run_id"), "*")
     .write.mode("append").parquet(layout.rejects(table_name)))


def read_rejects(spark: SparkSession, table_name: str, layout: Layout) -> DataFrame:
    """run_id, column_name, value, wanted, source_row of all runs of a table."""
    schema = "run_id string, column_name string, value string, wanted string, source_row string"
    if not fs.has_data_files(spark, layout.rejects(table_name)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(layout.rejects(table_name))


def _safe_ingest(spark, cfg, reader, layout, run_id, run_at, schemas) -> IngestResult:
    try:
        return ingest_table(spark, cfg, reader, layout, run_id=run_id, run_at=run_at,
                            target_schema=(schemas or {}).get(cfg.table))
    except Exception as e:  # noqa: BLE001 - recorded in the report, re-raised by the caller
        stored = None
        try:
            stored = read_watermark(spark, layout.watermark(cfg.table))
        except Exception:  # noqa: BLE001
            pass
        return IngestResult(run_id, run_at, cfg.table, FAILED, 0, cfg.from_date or stored,
                            stored, f"{type(e).__name__}: {e}")


def ingest_all(spark: SparkSession, configs: Sequence[SourceTable], reader: SourceReader,
               layout: Layout, *, run_id: str | None = None, run_at: str | None = None,
               max_parallel: int = 1, schemas: dict | None = None,
               raise_on_failure: bool = True, persist_report: bool = True,
               pipeline: str = "ingest") -> DataFrame:
    """Ingest every configured table; return the run report DataFrame. A run
    with a failed table ends in an error once all tables were tried and the
    report is stored (``raise_on_failure=False`` returns it instead).

    The report has one row per table (bounded by the config list), so it is
    built on the driver; it is also appended to the reports folder.
    """
    run_id = run_id or uuid.uuid4().hex
    run_at = run_at or utc_now()
    if max_parallel > 1:
        with ThreadPoolExecutor(max_workers=max_parallel) as pool:
            results = list(pool.map(
                lambda c: _safe_ingest(spark, c, reader, layout, run_id, run_at, schemas), configs))
    else:
        results = [_safe_ingest(spark, c, reader, layout, run_id, run_at, schemas) for c in configs]
    report = spark.createDataFrame([r.as_row(pipeline) for r in results], REPORT_SCHEMA)
    if persist_report:
        report.coalesce(1).write.mode("append").parquet(layout.reports())
    failed = [r for r in results if r.status == FAILED]
    if raise_on_failure and failed:
        raise RuntimeError(f"{pipeline} run {run_id}: {len(failed)} table(s) failed: "
                           + ", ".join(f"{r.table_name} ({r.error})" for r in failed))
    return report


def failures(report: DataFrame) -> DataFrame:
    """Alert feed: the FAILED rows of a run report."""
    return report.where(F.col("status") == FAILED)

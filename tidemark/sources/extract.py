"""Incremental extraction: the change window of a source table.

The window is ``low < cdc <= high``. ``high`` is the maximum change value
measured *before* the copy, in the same one-column aggregate that counts the
window's rows; bounding the copy by it means rows committed while the copy
runs are picked up by the next run instead of being skipped for good.
Rows with a NULL change value never qualify.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import typed_literal, watermark_string


def change_filter(df: DataFrame, cdc_col: str, low: str | None, high: str | None = None) -> Column:
    """Predicate of the extract window, with literals typed like the column so
    that the comparison is pushed to the scan / the database."""
    dtype = df.schema[cdc_col].dataType
    c = F.col(cdc_col)
    cond = c.isNotNull() if low is None else (c > typed_literal(low, dtype))
    if high is not None:
        cond = cond & (c <= typed_literal(high, dtype))
    return cond


def incremental_extract(df: DataFrame, cdc_col: str, low: str | None, high: str | None = None) -> DataFrame:
    """All columns of the rows inside the window (``SELECT * ... WHERE``)."""
    return df.where(change_filter(df, cdc_col, low, high))


def lookback_filter(df: DataFrame, cdc_col: str, mark: str, lookback: str) -> Column:
    """Rows at or below the mark, by no more than ``lookback`` (an interval such as
    "30 days", or a number for a numeric change column)."""
    dtype = df.schema[cdc_col].dataType
    c, low = F.col(cdc_col), typed_literal(mark, dtype)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        since = (low - F.expr(f"INTERVAL {lookback}")).cast(dtype)
    else:
        since = (low - F.lit(lookback).cast(dtype)).cast(dtype)
    return (c > since) & (c <= low)


def row_digest(columns: Mapping[str, Column]) -> Column:
    """128 bits of the named values of a row (NULLs included)."""
    return F.md5(F.to_json(F.struct(*[columns[c].alias(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}))


def late_rows(df: DataFrame, delivered: DataFrame, cdc_col: str, mark: str, lookback: str,
              form: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows of ``df`` in the look-back window that ``delivered`` does not hold: what was
    committed, or re-dated, below the mark after an earlier run. ``form`` says how
    ``delivered``'s columns were made from those of ``df`` (default: as they are). Only
    the window of both sides is read, and only digests of the delivered one are
    shuffled. Equal rows count as one. Without a delivered change column its whole
    table is compared."""
    own = "__digest"
    there = delivered.where(lookback_filter(delivered, cdc_col, mark, lookback)) if cdc_col in delivered.columns else delivered
    digests = there.select(row_digest({c: F.col(f"`{c}`") for c in there.columns}).alias(own)).distinct()
    window = df.where(lookback_filter(df, cdc_col, mark, lookback))
    form = form or {c: F.col(f"`{c}`") for c in df.columns}
    return window.withColumn(own, row_digest(form)).join(digests, own, "left_anti").drop(own)


@dataclass(frozen=True)
class WindowStats:
    rows: int
    high: str | None  # text form of the max change value in the window


def window_stats(df: DataFrame, cdc_col: str, low: str | None, window: DataFrame | None = None) -> WindowStats:
    """Row count and maximum change value above ``low`` in one aggregate.

    ``window`` is a one-row (n, high) result that the source has computed;
    without it only the change column is read (column pruning), the filter is
    pushed down, and Spark plans a partial + final aggregate: one small row
    comes back to the driver whatever the table size.
    """
    dtype = df.schema[cdc_col].dataType
    if window is None:
        window = (df.where(change_filter(df, cdc_col, low))
                  .agg(F.count(F.lit(1)).alias("n"), F.max(cdc_col).alias("high")))
    r = window.select("n", watermark_string(F.col("high").cast(dtype), dtype).alias("high")).first()
    return WindowStats(rows=int(r["n"]), high=r["high"])


def high_water_mark(df: DataFrame, cdc_col: str) -> DataFrame:
    """``SELECT MAX(cdc_col) AS cdc`` as a one-row DataFrame (typed)."""
    return df.agg(F.max(cdc_col).alias("cdc"))

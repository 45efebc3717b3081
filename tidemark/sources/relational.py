"""Source relations for extraction: JDBC tables, parquet folders, catalog tables.

A *source reader* is a callable ``(SourceTable) -> DataFrame`` that returns
the whole source relation lazily. Filters and aggregates applied afterwards
are pushed to the source by Catalyst (JDBC WHERE, parquet row-group
skipping), so the reader never materialises the table. A reader may also have
``window(cfg, low)``, a one-row (n, high) DataFrame that the source computes.
"""

from __future__ import annotations

import re
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..config import JdbcOptions, SourceTable

SourceReader = Callable[[SourceTable], DataFrame]


def _options(opts: JdbcOptions) -> dict[str, str]:
    return {"fetchsize": str(opts.fetch_size), "queryTimeout": str(opts.query_timeout_s),
            "preferTimestampNTZ": "true",   # a zone-less DATETIME stays zone-less
            **opts.properties}


def _jdbc(spark: SparkSession, opts: JdbcOptions):
    return spark.read.format("jdbc").option("url", opts.url).options(**_options(opts))


def jdbc_reader(spark: SparkSession, opts: JdbcOptions) -> SourceReader:
    """Read ``schema.table`` over JDBC, split into parallel range queries when
    a partition column is configured (the default single reader does not
    scale to large extracts)."""
    if (opts.partition_column is None) != (opts.num_partitions is None):
        raise ValueError("a split JDBC read needs partition_column and num_partitions")
    if (opts.lower_bound is None) != (opts.upper_bound is None):
        raise ValueError("a split JDBC read needs both lower_bound and upper_bound, or neither")

    def read(cfg: SourceTable) -> DataFrame:
        if opts.partition_column is not None and opts.lower_bound is None:
            cuts = [r[0] for r in _jdbc(spark, opts).option("query", cuts_query(cfg, opts)).load().collect()]
            return spark.read.jdbc(opts.url, cfg.qualified, predicates=range_predicates(opts.partition_column, cuts),
                                   properties={k: str(v) for k, v in _options(opts).items()})
        r = _jdbc(spark, opts).option("dbtable", cfg.qualified).option("pushDownPredicate", "true")
        if opts.partition_column is not None:
            r = (r.option("partitionColumn", opts.partition_column)
                 .option("lowerBound", str(opts.lower_bound))
                 .option("upperBound", str(opts.upper_bound))
                 .option("numPartitions", str(opts.num_partitions)))
        return r.load()

    # the window's count and maximum are computed by the database
    read.window = lambda cfg, low: jdbc_window(spark, opts, cfg, low)
    return read


def cuts_query(cfg: SourceTable, opts: JdbcOptions) -> str:
    """The query by which the database finds the first key of each of ``num_partitions``
    parts of equal row numbers: that many rows come through the connection."""
    c = opts.partition_column
    return (f"SELECT MIN({c}) AS cut FROM (SELECT {c}, NTILE({int(opts.num_partitions)}) OVER (ORDER BY {c}) AS part "
            f"FROM {cfg.qualified} WHERE {c} IS NOT NULL) q GROUP BY part")


def _literal(value: object) -> str:
    return str(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else "'" + str(value).replace("'", "''") + "'"


def range_predicates(column: str, cuts: Sequence[object]) -> list[str]:
    """Conditions of ranges that meet at the cut points and cover every row once,
    NULLs in the first."""
    inner = [_literal(c) for c in sorted(set(cuts))[1:]]
    if not inner:
        return ["1 = 1"]
    return [f"{column} < {inner[0]} OR {column} IS NULL",
            *(f"{column} >= {a} AND {column} < {b}" for a, b in zip(inner, inner[1:])),
            f"{column} >= {inner[-1]}"]


def mark_literal(low: str, fraction_digits: int) -> str:
    """A stored mark as a text literal the database accepts for its column: fraction
    digits beyond the column's are cut off. Cutting goes down, so the window can
    only grow by rows that share the mark's last digit."""
    m = re.fullmatch(r"(.*\d:\d\d:\d\d)\.(\d+)", low)
    if m:
        low = m[1] + ("." + m[2][:fraction_digits] if fraction_digits else "")
    return _literal(low)


def window_query(cfg: SourceTable, low: str | None, fraction_digits: int = 3) -> str:
    """The query that counts a change window and finds its end in the database.
    ``low`` is a stored mark, written as a text literal the database compares
    in the column's type."""
    where = f"{cfg.cdc_col} IS NOT NULL" if low is None else f"{cfg.cdc_col} > {mark_literal(low, fraction_digits)}"
    return f"SELECT COUNT(*) AS n, MAX({cfg.cdc_col}) AS high FROM {cfg.qualified} WHERE {where}"


def jdbc_window(spark: SparkSession, opts: JdbcOptions, cfg: SourceTable, low: str | None) -> DataFrame:
    """(n, high) of the window: one row comes through the connection."""
    return _jdbc(spark, opts).option("query", window_query(cfg, low, opts.fraction_digits)).load()


def parquet_reader(spark: SparkSession, paths: Mapping[str, str]) -> SourceReader:
    """Source tables stored as parquet (tests, lake-to-lake copies)."""

    def read(cfg: SourceTable) -> DataFrame:
        return spark.read.parquet(paths[cfg.table])

    return read


def frame_reader(frames: Mapping[str, DataFrame]) -> SourceReader:
    """Source tables given as DataFrames (e.g. a source state in a test)."""

    def read(cfg: SourceTable) -> DataFrame:
        return frames[cfg.table]

    return read


def catalog_reader(spark: SparkSession) -> SourceReader:
    """Source tables registered in the session catalog as ``schema.table``."""

    def read(cfg: SourceTable) -> DataFrame:
        return spark.table(cfg.qualified)

    return read

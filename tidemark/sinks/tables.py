"""Catalog tables over our folders: create, drop, reset, preview."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import fs
from ..config import Namespace


def use_namespace(spark: SparkSession, ns: Namespace) -> None:
    """Make ``ns`` the current catalog / schema (dev vs prod parameters)."""
    if ns.catalog:
        spark.catalog.setCurrentCatalog(ns.catalog)
    if ns.schema:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{ns.schema}`")
        spark.catalog.setCurrentDatabase(ns.schema)


def create_table(spark: SparkSession, name: str, path: str, schema: T.StructType | None = None,
                 fmt: str = "parquet") -> DataFrame:
    """Register an external table over ``path`` (created empty if a schema
    is given and nothing is there yet)."""
    if schema is not None and not fs.has_data_files(spark, path):
        spark.createDataFrame([], schema).write.mode("ignore").format(fmt).save(path)
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source=fmt)
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def reset_table(spark: SparkSession, name: str | None, folders: list[str], guard_root: str) -> None:
    """Drop the table and delete its data / checkpoint folders (only inside
    ``guard_root``) so the next run reloads from scratch."""
    if name:
        drop_table(spark, name)
    for f in folders:
        fs.remove(spark, f, guard_root)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows for a look (a limit is the feature here)."""
    return df.limit(n)

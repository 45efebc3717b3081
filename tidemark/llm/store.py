"""Intermediate tables in the shared work folder.

``spark.checkpoint.dir`` names the folder every executor sees; writing a
table there cuts the lineage, so a lost executor costs a re-read and not a
recomputation.
"""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch  # noqa: F401  (operators that write their own files)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder, and read again."""
    spark = df.sparkSession
    path = scratch(spark, f"llm_{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts: one native pass, used to size buckets."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def bucket_count(n_bytes: int, per_bucket: int, least: int = 8) -> int:
    """Buckets in proportion to the data, so that one bucket keeps its size."""
    return max(least, -(-n_bytes // per_bucket))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application
    (they import the modules whose functions run in tasks)."""
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="tidemark-py-")  # read by the driver only
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "tidemark"), "zip",
                                     os.path.dirname(package), os.path.basename(package)))
    sc._tidemark_shipped = True


def slices(batches, rows: int):
    """Arrow batches in slices of at most ``rows`` rows, so that a worker makes
    Python objects of a few of them at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def arrow_map(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def arrow_groups(df: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """``groupBy(keys).applyInArrow`` with this package at hand."""
    ship(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(fn, schema)

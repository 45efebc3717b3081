"""Bronze landing: append the extracted rows of one run as parquet files.

Bronze is one flat folder per table so that the silver file stream sees
every run's files. Each run adds complete files only (Spark's commit
protocol moves finished task files into place), so a reader that sees part
of a run gets the rest on its next trigger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_bronze(df: DataFrame, folder: str, max_records_per_file: int = 5_000_000) -> None:
    """Append rows as snappy parquet. The caller has already checked the
    delta is non-empty, so no empty file is ever written."""
    (df.write.mode("append")
     .option("compression", "snappy")
     .option("maxRecordsPerFile", str(max_records_per_file))
     .parquet(folder))

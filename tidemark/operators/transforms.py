"""Row transforms of the silver layer, usable with ``DataFrame.transform``.

They work the same on batch and streaming DataFrames.
"""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame

from ..functions.columns import DURATION_BANDS, DURATION_DEFAULT, band, replace_all, upper

RESCUED = "_rescued_data"


def drop_columns(columns: Iterable[str]):
    cols = list(columns)
    return lambda df: df.drop(*cols)


def with_columns(exprs: Mapping[str, Column]):
    """Derive new columns or replace existing ones in place."""
    return lambda df: df.withColumns(dict(exprs))


def with_constants(values: Mapping[str, object]):
    """Add the same literal value(s) to every row (``additionalColumns``)."""
    from pyspark.sql import functions as F
    return lambda df: df.withColumns({k: F.lit(v) for k, v in values.items()})


def upper_case(*cols: str):
    return lambda df: df.withColumns({c: upper(c) for c in cols})


def replace_in(col: str, pattern: str, replacement: str):
    return lambda df: df.withColumn(col, replace_all(col, pattern, replacement))


def banded(col: str, out: str, edges: Sequence[tuple[object, str]], default: str):
    return lambda df: df.withColumn(out, band(col, edges, default))


def drop_rescued(df: DataFrame) -> DataFrame:
    return df.drop(RESCUED)


# --- the silver recipes of the reference's five tables -----------------------

def clean_users(df: DataFrame) -> DataFrame:
    return df.transform(upper_case("user_name")).transform(drop_rescued)


def clean_tracks(df: DataFrame) -> DataFrame:
    return (df.transform(banded("duration_sec", "durationFlag", DURATION_BANDS, DURATION_DEFAULT))
            .transform(replace_in("track_name", "-", " "))
            .transform(drop_rescued))

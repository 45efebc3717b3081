"""Change application as pure DataFrame functions (batch form).

* SCD type 1: one row per key, the greatest ``sequence_by`` wins; events
  older than what is stored are ignored, whatever order they arrive in.
* SCD type 2: one row per version with ``__START_AT`` / ``__END_AT``
  (``__END_AT`` NULL = current). With no exclusion list every distinct
  sequence point is a version; with ``except_cols`` a new version opens
  only when a tracked column (any column not listed, the sequence column
  included) changes, and the untracked columns of a version carry the
  values of its latest event.

Fixed semantics:
* rows with a NULL sequence value are not applied;
* NULL keys are one key like any other (null-safe matching);
* several events with the same (key, sequence): identical rows collapse,
  otherwise the greatest row (struct order of the remaining columns) wins,
  so results never depend on arrival order or partitioning.

These functions are also the building blocks of the incremental merge in
``tidemark.streaming.gold``: merging a batch into a target is the same
computation restricted to the keys the batch touches.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import key_struct
from .sequence import CHUNK, CUTS, HOT_ROWS, KEY, SKIP, chunked, last_of_runs, with_next

START = "__START_AT"
END = "__END_AT"
INTERVAL_COLS = (START, END)


#: columns the engine adds itself; a source must not bring them
OWN_COLS = frozenset((*INTERVAL_COLS, KEY, CHUNK, CUTS, SKIP, "__bucket", "__w", "__run", "__arrival"))


def data_columns(df: DataFrame) -> list[str]:
    """The source's columns. A name the engine uses itself is an error: taking
    the column for the engine's would lose its values."""
    clash = sorted(OWN_COLS.intersection(df.columns))
    if clash:
        raise ValueError(f"column names reserved by the engine: {', '.join(clash)}")
    return list(df.columns)


def valid_sequence(df: DataFrame, seq: str) -> DataFrame:
    return df.where(F.col(seq).isNotNull())


def _keyed(df: DataFrame, keys: Sequence[str], seq: str, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, bool]:
    """Valid rows with the key struct and the chunk column; whether any key is split."""
    return chunked(valid_sequence(df, seq).withColumn(KEY, key_struct(keys)), seq, hot_rows)


def _prepare(keyed: DataFrame, split: bool = True) -> DataFrame:
    """One shuffle on (key, chunk), on the key where none is split, that the tie
    aggregate and every window of the SCD2 computation reuse (no further exchange
    of the wide rows)."""
    return keyed.repartition(KEY, CHUNK) if split else keyed.repartition(KEY)


def _resolve_ties(df: DataFrame, seq: str, cols: Sequence[str]) -> DataFrame:
    rest = [c for c in cols if c != seq]
    if not rest:
        return df.dropDuplicates([KEY, CHUNK, seq])
    return (df.groupBy(KEY, CHUNK, seq)
            .agg(F.max(F.struct(*rest)).alias("__w"))
            .select(KEY, CHUNK, seq, "__w.*"))


def resolve_ties(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """One row per (key, sequence); see module doc for the winner rule."""
    cols = df.columns
    rest = [c for c in cols if c not in keys and c != seq]
    if not rest:
        return valid_sequence(df, seq).dropDuplicates(list(keys) + [seq])
    return (valid_sequence(df, seq).groupBy(*keys, seq)
            .agg(F.max(F.struct(*rest)).alias("__w"))
            .select(*keys, seq, "__w.*")
            .select(*cols))


def scd1_latest(events: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Latest row per key. ``max(struct(seq, rest...))`` is a plain aggregate:
    Spark combines it map-side, so a hot key is reduced before the shuffle."""
    cols = data_columns(events)
    rest = [c for c in cols if c not in keys and c != seq]
    return (valid_sequence(events.select(*cols), seq)
            .groupBy(*keys)
            .agg(F.max(F.struct(seq, *rest)).alias("__w"))
            .select(*keys, "__w.*")
            .select(*cols))


def scd2_versions(events: DataFrame, keys: Sequence[str], seq: str,
                  except_cols: Sequence[str] | None = None,
                  hot_rows: int = HOT_ROWS, resolved: bool = False) -> DataFrame:
    """All versions with validity intervals from a set of events. A key with
    ``hot_rows`` events or more is spread over tasks.

    ``resolved=True`` says the events are already one row per (key,
    sequence) (``resolve_ties`` output), which skips a sort of every row.
    """
    cols = data_columns(events)
    keyed, split = _keyed(events, keys, seq, hot_rows)
    p = _prepare(keyed, split)
    if not resolved:
        p = _resolve_ties(p, seq, cols)
    if except_cols is None:
        v = with_next(p, seq, END, keyed if split else None)
        return v.select(*cols, F.col(seq).alias(START), END)
    # every non-key column is tracked unless listed -- the sequence column
    # too, so it must be listed for versions to collapse
    tracked = [c for c in cols if c not in keys and c not in set(except_cols)]
    # with every column excluded a key has one version
    v = last_of_runs(p, seq, F.struct(*([F.col(c) for c in tracked] or [F.lit(True)])), START, END, split)
    return v.select(*cols, START, END)


def current_versions(target: DataFrame) -> DataFrame:
    """Open versions of an SCD2 table."""
    return target.where(F.col(END).isNull())


def closed_versions(target: DataFrame) -> DataFrame:
    """History query: versions that have been superseded."""
    return target.where(F.col(END).isNotNull())


def lineage(target: DataFrame, key: str, values: Sequence[object]) -> DataFrame:
    """Current and past versions of the given keys side by side."""
    return target.where(F.col(key).isin(list(values)))

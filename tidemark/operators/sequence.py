"""Per-key sequence operations that survive a hot key.

A plain ``Window.partitionBy(key).orderBy(seq)`` sends every row of a key
to one task; if one key holds a third of the rows, that task holds a third
of the data. Here keys are counted (an aggregate combined map-side, one number per
key). A key of ``HOT_ROWS`` rows or more is split into *chunks* of about equal
size, by cut points measured on its own rows (``percentile_approx``), so a burst
inside a minute is split like one over years. All other keys are one chunk.

The window runs per (key, chunk), and the rows are shuffled once, on
(key, chunk). What crosses the chunks of a hot key comes from one small row per
(key, chunk) of hot keys, joined back on (key, chunk). When the count finds no
hot key, the plan is the plain window alone.

All functions take the key as one column (``__key``, a struct of the key
columns, so NULL keys match like any other value).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "__key"
CHUNK = "__chunk"
CUTS = "__cuts"

HOT_ROWS = 250_000
#: a hot key has up to STEPS * STEPS chunks
STEPS = 32


SKIP = "__skip"


def measure(seq: str, dtype: T.DataType) -> Column | None:
    """A value of which quantiles can be taken and that never falls while the sequence
    rises (``None``: the type has none, its keys are not split). Texts count by the
    7 bytes behind the beginning that all texts of the key share (``__skip``)."""
    c = F.col(seq)
    if isinstance(dtype, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(dtype, T.StringType):
        part = F.substr(c.cast("binary"), F.col(SKIP) + 1, F.lit(7))
        return F.conv(F.rpad(F.hex(part), 14, "0"), 16, 10).cast("long")
    return None


def _shared(a: Column, b: Column) -> Column:
    """Length of the beginning that two byte strings share."""
    n = F.least(F.octet_length(a), F.octet_length(b))
    same = F.filter(F.sequence(F.lit(0), n), lambda i: F.substr(a, F.lit(1), i) == F.substr(b, F.lit(1), i))
    return F.size(same) - 1


def hot_keys(keyed: DataFrame, seq: str, by: Column, hot_rows: int) -> DataFrame:
    """(key, what its texts share, cut points) of the keys with ``hot_rows`` rows or
    more: at most 1 / hot_rows as many rows as the input. Only their rows are looked
    at again."""
    text = isinstance(keyed.schema[seq].dataType, T.StringType)
    ends = [f(F.col(seq).cast("binary")).alias(n) for f, n in ((F.min, "__lo"), (F.max, "__hi"))] if text else []
    skip = _shared(F.col("__lo"), F.col("__hi")) if text else F.lit(0)
    hot = (keyed.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"), *ends).where(F.col("n") >= hot_rows)
           .select(KEY, skip.alias(SKIP)))
    shares = ", ".join(f"{i / STEPS ** 2!r}D" for i in range(1, STEPS ** 2))
    return (keyed.join(hot, KEY).withColumn("__by", by)
            .groupBy(KEY, SKIP).agg(F.expr(f"percentile_approx(__by, array({shares}), 5000)").alias(CUTS)))


def chunk_of(by: Column) -> Column:
    """Number of a hot key's cut points at or below the row, found in two steps."""
    cuts = F.col(CUTS)
    coarse = F.size(F.filter(F.transform(F.sequence(F.lit(STEPS), F.lit(STEPS * (STEPS - 1)), F.lit(STEPS)),
                                         lambda i: F.element_at(cuts, i)), lambda x: x <= by))
    fine = F.size(F.filter(F.slice(cuts, coarse * STEPS + 1, F.lit(STEPS - 1)), lambda x: x <= by))
    return F.when(cuts.isNull(), F.lit(0)).otherwise(coarse * STEPS + fine)


def chunked(keyed: DataFrame, seq: str, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, bool]:
    """``keyed`` (with ``__key``) and its ``__chunk``, -1 for keys that are whole; and
    whether any key is split. Keys are counted here, in a job that returns one row."""
    by = measure(seq, keyed.schema[seq].dataType)
    if by is None or keyed.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= hot_rows).isEmpty():
        return keyed.withColumn(CHUNK, F.lit(-1)), False
    hot = hot_keys(keyed.select(KEY, seq), seq, by, hot_rows)
    return (keyed.join(hot, KEY, "left")
            .withColumn(CHUNK, F.when(F.col(CUTS).isNull(), F.lit(-1)).otherwise(chunk_of(by))).drop(CUTS, SKIP)), True


def with_next(df: DataFrame, seq: str, out: str, keyed: DataFrame | None) -> DataFrame:
    """``out`` = the next ``seq`` of the same key (NULL on the last row).

    Expects columns ``__key`` and ``__chunk``; (key, seq) must be unique. ``keyed`` are
    the same rows before their shuffle (duplicates of (key, seq) allowed): the first
    ``seq`` of every chunk of a hot key is aggregated from it map-side. ``None``: no
    key is split.
    """
    w = Window.partitionBy(KEY, CHUNK).orderBy(seq)
    if keyed is None:
        return df.withColumn(out, F.lead(seq).over(w))
    wc = Window.partitionBy(KEY).orderBy(CHUNK)
    edge = (keyed.where(F.col(CHUNK) >= 0).groupBy(KEY, CHUNK).agg(F.min(seq).alias("__cfirst"))
            .withColumn("__cnext", F.lead("__cfirst").over(wc)).select(KEY, CHUNK, "__cnext"))
    return (df.withColumn(out, F.lead(seq).over(w)).join(edge, [KEY, CHUNK], "left")
            .withColumn(out, F.coalesce(F.col(out), F.col("__cnext")))
            .drop("__cnext"))


def last_of_runs(df: DataFrame, seq: str, tracked: Column, start: str, end: str, split: bool = True) -> DataFrame:
    """The last row of every run of equal ``tracked`` values per key in ``seq``
    order (NULL-safe), with the run's first ``seq`` as ``start`` and the next
    run's first ``seq`` as ``end`` (NULL for the last run).

    Expects ``__key`` and ``__chunk``; (key, seq) unique. The rows are shuffled
    once, on (key, chunk); what crosses the chunks of hot keys travels in one
    small row per (key, chunk); ``split=False``: no key is split.
    """
    w = Window.partitionBy(KEY, CHUNK).orderBy(seq)
    begun = F.last("__begins", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    df = (df.withColumn("__tv", F.struct(tracked.alias("v")))  # never NULL: a NULL below means "no row"
          .withColumn("__prev", F.lag("__tv").over(w))
          .withColumn("__next", F.lead("__tv").over(w))
          .withColumn("__next_seq", F.lead(seq).over(w))
          .withColumn("__opening", F.first(seq).over(w))
          # first row of a run inside the chunk; the chunk's first row is decided below
          .withColumn("__begins", F.when(F.col("__prev").isNotNull() & ~F.col("__prev").eqNullSafe(F.col("__tv")), F.col(seq))))
    own = ["__tv", "__prev", "__next", "__next_seq", "__begins", "__begun", "__opening"]
    if not split:
        return (df.withColumn("__begun", begun).where(F.col("__next").isNull() | ~F.col("__next").eqNullSafe(F.col("__tv")))
                .withColumn(start, F.coalesce("__begun", "__opening")).withColumn(end, F.col("__next_seq")).drop(*own))
    wc = Window.partitionBy(KEY).orderBy(CHUNK)
    edge = (df.where(F.col(CHUNK) >= 0).groupBy(KEY, CHUNK).agg(
        F.min(seq).alias("__cfirst"), F.min_by("__tv", seq).alias("__cfirst_v"),
        F.max_by("__tv", seq).alias("__clast_v"), F.max("__begins").alias("__cbegin"))
        .withColumn("__before_v", F.lag("__clast_v").over(wc))
        .withColumn("__opens", F.when(F.col("__before_v").isNull()
                                      | ~F.col("__before_v").eqNullSafe(F.col("__cfirst_v")), F.col("__cfirst")))
        .withColumn("__carried", F.last(F.coalesce("__cbegin", "__opens"), ignorenulls=True).over(
            wc.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("__after_v", F.lead("__cfirst_v").over(wc))
        .withColumn("__after_seq", F.lead("__cfirst").over(wc))
        .select(KEY, CHUNK, "__opens", "__carried", "__after_v", "__after_seq"))
    df = (df.withColumn("__begun", begun)
        .join(edge, [KEY, CHUNK], "left")
        .withColumn("__next", F.coalesce("__next", "__after_v"))
        .where(F.col("__next").isNull() | ~F.col("__next").eqNullSafe(F.col("__tv")))
        # a key that is whole has its first run begin at its first row
        .withColumn(start, F.coalesce("__begun", "__opens", "__carried", "__opening"))
        .withColumn(end, F.coalesce("__next_seq", "__after_seq")))
    return df.drop(*own, "__opens", "__carried", "__after_v", "__after_seq")

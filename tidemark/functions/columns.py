"""Column-level helpers. All of them return native Catalyst expressions, so
they stay inside whole-stage codegen and push down where Spark can."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the track-duration banding used by the silver tracks table
# (seconds; strict "<" at each edge, anything else incl. NULL is the default).
DURATION_BANDS = ((150, "low"), (300, "medium"))
DURATION_DEFAULT = "high"


def upper(col: str) -> Column:
    """Upper-case a string column (NULL stays NULL)."""
    return F.upper(F.col(col))


def replace_all(col: str, pattern: str, replacement: str) -> Column:
    """Regex replace of every match (Java regex semantics)."""
    return F.regexp_replace(F.col(col), pattern, replacement)


def band(col: str, edges: Sequence[tuple[object, str]], default: str) -> Column:
    """``CASE WHEN c < e1 THEN l1 WHEN c < e2 THEN l2 ... ELSE default``.

    Edges are checked in order with a strict ``<``; a NULL input fails every
    test and therefore gets ``default`` (same as the SQL CASE).
    """
    if not edges:
        return F.lit(default)
    expr = None
    for edge, label in edges:
        cond = F.col(col) < F.lit(edge)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def typed_literal(value: str, dtype: T.DataType) -> Column:
    """A literal of the column's own type, so comparisons against it do not
    wrap the column in a cast and still push down to the source/scan."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.to_timestamp_ntz(F.lit(value))
    if isinstance(dtype, T.TimestampType):
        return F.to_timestamp(F.lit(value))
    if isinstance(dtype, T.DateType):
        return F.to_date(F.lit(value))
    return F.lit(value).cast(dtype)


def watermark_string(col: Column | str, dtype: T.DataType) -> Column:
    """Lossless text form of a change-column value for the watermark document.

    Timestamps keep all six fractional digits so that ``> mark`` never
    re-reads or skips rows because of rounding.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    return c.cast("string")


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop a list of columns; names that are not present are ignored."""
    return df.drop(*list(columns))


def key_struct(keys: Sequence[str]) -> Column:
    """All key columns as one non-null struct.

    Struct equality treats NULL fields as equal, so plain equi-joins and
    window partitions on this column give null-safe key matching without
    the ``<=>`` rewrite that would defeat partitioning reuse.
    """
    return F.struct(*[F.col(k) for k in keys])


_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def key_class(dtype: T.DataType) -> str:
    """Types of one class hold equal keys in equal canonical form."""
    if dtype in _WHOLE:
        return "whole"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "real"
    if isinstance(dtype, T.DecimalType):
        return f"decimal:{dtype.scale}"
    if isinstance(dtype, _TIMES):
        return "time"
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    return dtype.simpleString()


def canonical(col: str, dtype: T.DataType) -> Column:
    """A key column in the widest type of its class: a key has the same form (and
    hash) whether its column is an int today or a bigint tomorrow."""
    c, kind = F.col(f"`{col}`"), key_class(dtype)
    if kind == "whole":
        return c.cast("long")
    if kind == "real":
        return c.cast("double") + F.lit(0.0)   # -0.0 is 0.0
    if kind.startswith("decimal"):
        return c.cast(T.DecimalType(38, dtype.scale))
    if kind == "time":
        return c.cast("timestamp_ntz")
    return c.cast("string") if kind == "text" else c


def key_classes(schema: T.StructType, keys: Sequence[str]) -> list[str]:
    return [key_class(schema[k].dataType) for k in keys]


def canonical_key(schema: T.StructType, keys: Sequence[str]) -> Column:
    """All key columns in canonical form as one non-null struct (see ``key_struct``)."""
    return F.struct(*[canonical(k, schema[k].dataType).alias(k) for k in keys])


def bucket_of(schema: T.StructType, keys: Sequence[str], buckets: int, width: int | None = None) -> Column:
    """Stable bucket number of a key, whatever type of its class the column has.

    Hash buckets (default): ``pmod(xxhash64(keys), buckets)`` of the canonical
    keys -- a fixed number of evenly filled buckets, for keys that are updated anywhere.
    Range buckets (``width`` set, one integral key): ``floor(key / width)``
    -- for keys that grow over time (fact ids): new keys fill new buckets and
    late changes touch recent ones only, so a merge rewrites recent data,
    not the whole target. NULL keys go to bucket -1.
    """
    if width is not None:
        if len(keys) != 1:
            raise ValueError("range buckets need exactly one integral key")
        return F.coalesce(F.floor(F.col(keys[0]) / F.lit(width)), F.lit(-1)).cast("long")
    return F.pmod(F.xxhash64(*[canonical(k, schema[k].dataType) for k in keys]), F.lit(buckets)).cast("long")


def _converted(c: Column, dtype: T.DataType, truncate: bool) -> Column:
    if isinstance(dtype, (T.VarcharType, T.CharType)):
        c = c.cast("string")
        return F.left(c, F.lit(dtype.length)) if truncate else F.when(F.length(c) <= dtype.length, c)
    return c.try_cast(dtype) if truncate else c.cast(dtype)


def casted_to(df: DataFrame, schema: T.StructType, truncate: bool = True) -> DataFrame:
    """Convert columns to a declared schema (type conversion on copy).

    ``truncate=True`` cuts what a type can't hold in full (fractions of whole numbers,
    texts longer than VARCHAR(n)); values that do not convert at all become NULL
    instead of failing the job (``misfits`` tells which). ``False`` fails on the first
    bad value. Columns missing from ``df`` are added as NULL; extra columns are dropped.
    """
    return df.select(*[c.alias(n) for n, c in conversions(df, schema, truncate).items()])


def conversions(df: DataFrame, schema: T.StructType, truncate: bool = True) -> dict[str, Column]:
    """column -> the expression by which ``casted_to`` makes it."""
    present = set(df.columns)
    out = {}
    for f in schema.fields:
        kind = T.StringType() if isinstance(f.dataType, (T.VarcharType, T.CharType)) else f.dataType
        out[f.name] = (_converted(F.col(f"`{f.name}`"), f.dataType, truncate) if f.name in present
                       else F.lit(None).cast(kind))
    return out


def misfits(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    """column -> whether its value is lost when ``casted_to`` converts it."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return {f.name: F.col(f"`{f.name}`").isNotNull() & _converted(F.col(f"`{f.name}`"), f.dataType, True).isNull()
            for f in schema.fields if f.name in have and have[f.name] != f.dataType}


def rejected(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per value that does not convert: column, value (as text), wanted type and
    the row it came from (JSON)."""
    lost = misfits(df, schema)
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    empty = df.select(*[F.lit(None).cast("string").alias(c) for c in ("column_name", "value", "wanted", "source_row")]).where("false")
    if not lost:
        return empty
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    each = [F.when(bad, F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value"),
                                 F.lit(kinds[c]).alias("wanted"))) for c, bad in lost.items()]
    return (df.select(F.filter(F.array(*each), lambda x: x.isNotNull()).alias("found"), row.alias("source_row"))
            .select(F.explode("found").alias("x"), "source_row").select("x.*", "source_row"))


_DIGITS = dict(zip(("tinyint", "smallint", "int", "bigint"), (3, 5, 10, 19), strict=True))


def _decimal(t: T.DataType) -> T.DecimalType | None:
    return t if isinstance(t, T.DecimalType) else T.DecimalType(_DIGITS[t.simpleString()], 0) if t in _WHOLE else None


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of both: the wider number, the timestamp of a
    date and a timestamp, else text (also for more than 38 digits)."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return _WHOLE[max(_WHOLE.index(a), _WHOLE.index(b))]
    numbers = (T.FloatType, T.DoubleType)
    if (a in _WHOLE or isinstance(a, numbers)) and (b in _WHOLE or isinstance(b, numbers)):
        return T.DoubleType()
    if (isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType)) and _decimal(a) and _decimal(b):
        x, y = _decimal(a), _decimal(b)
        scale = max(x.scale, y.scale)
        digits = max(x.precision - x.scale, y.precision - y.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    if isinstance(a, _TIMES) and isinstance(b, _TIMES):
        return next((t for t in (a, b) if not isinstance(t, T.DateType)), a)
    return T.StringType()


def reads_as(stored: T.DataType, wanted: T.DataType) -> bool:
    """Whether Parquet files of the stored type can be read as the wanted one."""
    if stored == wanted:
        return True
    if stored in _WHOLE and wanted in _WHOLE:
        return _WHOLE.index(stored) <= _WHOLE.index(wanted)
    if isinstance(wanted, T.DoubleType):
        return stored in _WHOLE[:3] or isinstance(stored, T.FloatType)
    return isinstance(stored, T.DateType) and isinstance(wanted, T.TimestampNTZType)


def wider_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """``old`` with the columns only ``new`` has appended, every column in a
    type that holds both sides' values."""
    by_name = {f.name: f for f in new.fields}
    kept = [T.StructField(f.name, wider_type(f.dataType, by_name[f.name].dataType) if f.name in by_name else f.dataType)
            for f in old.fields]
    names = set(old.fieldNames())
    return T.StructType(kept + [T.StructField(f.name, f.dataType) for f in new.fields if f.name not in names])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns and types of ``schema``; missing ones are NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        (F.lit(None).cast(f.dataType) if f.name not in have
         else F.col(f"`{f.name}`") if have[f.name] == f.dataType else F.col(f"`{f.name}`").cast(f.dataType)).alias(f.name)
        for f in schema.fields])

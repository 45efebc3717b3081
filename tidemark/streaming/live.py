"""Which folders of a keyed target are live.

A merge writes its result into a new folder that no reader looks at, and then
one small numbered file that says, for every bucket, which folder holds it.
Readers follow the file with the highest number. A run that stops anywhere
before that file leaves the target as it was; folders it left behind are never
read. One writer per target at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import fs
from ..functions.columns import conform, wider_schema

BUCKET = "__bucket"


@dataclass
class Live:
    """State of a target: per part (``data``, ``events``) the folder of every
    bucket, and the schema each folder was written with."""

    number: int = 0
    parts: dict[str, dict[str, str]] = field(default_factory=dict)
    schemas: dict[str, dict] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    keys: list[str] = field(default_factory=list)   # canonical forms the buckets were made of

    def schema(self, part: str) -> T.StructType | None:
        """The widest schema of the part's folders (without the bucket)."""
        own = sorted({f for f in self.parts.get(part, {}).values()})
        found = [T.StructType.fromJson(self.schemas[f]) for f in own]
        return reduce(wider_schema, found) if found else None


def _pointers(target: str) -> str:
    return f"{target}/_live"


def latest(spark: SparkSession, target: str) -> Live:
    names = [n for n in fs.list_names(spark, _pointers(target)) if n.endswith(".json") and not n.startswith(".")]
    if not names:
        return Live()
    return Live(**json.loads(fs.read_text(spark, f"{_pointers(target)}/{max(names)}")))


def rows(spark: SparkSession, target: str, live: Live, part: str, buckets: list | None = None) -> DataFrame | None:
    """Rows of a part (all, or of some buckets) with ``__bucket``; columns that
    a folder does not have yet are NULL. ``None`` if nothing is stored."""
    names = live.parts.get(part, {})
    if buckets is not None:
        wanted = {f"{BUCKET}={b}" for b in buckets}
        names = {b: f for b, f in names.items() if b in wanted}
    if not names:
        return None
    schema = live.schema(part)
    by_folder: dict[str, list[str]] = {}
    for b, f in names.items():
        by_folder.setdefault(f, []).append(b)
    found = []
    for f, bs in sorted(by_folder.items()):
        own = T.StructType.fromJson(live.schemas[f])
        base = f"{target}/{part}/{f}"
        df = (spark.read.schema(T.StructType([*own.fields, T.StructField(BUCKET, T.LongType())]))
              .option("basePath", base).parquet(*[f"{base}/{b}" for b in sorted(bs)]))
        found.append(conform(df, T.StructType([*schema.fields, T.StructField(BUCKET, T.LongType())])))
    return reduce(DataFrame.unionByName, found)


def stage(df: DataFrame, target: str, part: str) -> tuple[str, str, dict]:
    """Write ``df`` (with ``__bucket``) to a new folder: (part, folder, schema)."""
    folder = f"merge={uuid.uuid4().hex[:12]}"
    (df.write.option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(f"{target}/{part}/{folder}"))
    own = T.StructType([f for f in df.schema.fields if f.name != BUCKET])
    return part, folder, json.loads(own.json())


def staged_rows(spark: SparkSession, target: str, staged: tuple[str, str, dict]) -> DataFrame:
    part, folder, schema = staged
    own = T.StructType.fromJson(schema)
    return (spark.read.schema(T.StructType([*own.fields, T.StructField(BUCKET, T.LongType())]))
            .parquet(f"{target}/{part}/{folder}"))


def publish(spark: SparkSession, target: str, live: Live, staged: list[tuple[str, str, dict]],
            flow: str, batch_id: int, keys: list[str], whole: bool = False) -> Live:
    """Make the staged folders live for the buckets they hold (``whole``: for the
    whole part), then drop folders that neither this state nor the one before it
    names. Catalog names of the target follow."""
    parts = {p: dict(b) for p, b in live.parts.items()}
    schemas = dict(live.schemas)
    for part, folder, schema in staged:
        if whole:
            parts[part] = {}
        for b in fs.list_dirs(spark, f"{target}/{part}/{folder}"):
            if b.startswith(f"{BUCKET}="):
                parts.setdefault(part, {})[b] = folder
        schemas[folder] = schema
    used = {f for b in parts.values() for f in b.values()}
    new = Live(live.number + 1, parts, {f: s for f, s in schemas.items() if f in used},
               {**live.batches, flow: int(batch_id)}, list(keys))
    fs.write_text(spark, f"{_pointers(target)}/{new.number:012d}.json", json.dumps(new.__dict__))
    for name in names(spark, target):
        # a name of another session's catalog is that session's to bring up to date
        if spark.catalog.tableExists(_parts_name(name)):
            follow(spark, target, name, new)
    before = {f for b in live.parts.values() for f in b.values()}
    for part in parts:
        for folder in fs.list_dirs(spark, f"{target}/{part}"):
            # a reader of the previous state may still be at work
            if folder.startswith("merge=") and folder not in used | before:
                fs.remove(spark, f"{target}/{part}/{folder}", target)
    return new


# --- catalog names ------------------------------------------------------------

_STATE = "tidemark.state"


def _parts_name(name: str) -> str:
    return f"{name}__parts"


def names(spark: SparkSession, target: str) -> list[str]:
    """Catalog names given to the target."""
    return [n.removesuffix(".name") for n in fs.list_names(spark, f"{target}/_names") if n.endswith(".name")]


def register(spark: SparkSession, target: str, name: str) -> None:
    """Name the target in the catalog: an external table partitioned by bucket, whose
    partition locations are the live folders, and a view of it without the bucket."""
    live = latest(spark, target)
    if not live.parts.get("data"):
        raise ValueError(f"nothing has been merged into {target}")
    if name not in names(spark, target):
        fs.write_text(spark, f"{target}/_names/{name}.name", name)
    follow(spark, target, name, live)


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def _locations(spark: SparkSession, table: str) -> dict[str, str]:
    """The state a table was brought to: folder of every bucket."""
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    n = int(props.get(f"{_STATE}.pieces", 0))
    return json.loads("".join(props[f"{_STATE}.{i}"] for i in range(n))) if n else {}


def follow(spark: SparkSession, target: str, name: str, live: Live) -> None:
    """Bring a catalog name to the state ``live``: new columns are added, buckets that
    moved get their new location. Readers of a name see every bucket (every key)
    in one state."""
    table, schema, parts = _parts_name(name), live.schema("data"), live.parts["data"]
    old = [f for f in spark.table(table).schema.fields if f.name != BUCKET] if spark.catalog.tableExists(table) else None
    new_columns = False
    if old is not None and (schema.fieldNames()[:len(old)] != [f.name for f in old]
                            or any(schema[f.name].dataType != f.dataType for f in old)):
        spark.sql(f"DROP TABLE {table}")   # a type became wider: an external table, its files stay
        old = None
    if old is None:
        spark.sql(f"CREATE TABLE {table} ({_columns(schema)}, {BUCKET} BIGINT) USING parquet PARTITIONED BY ({BUCKET}) "
                  f"LOCATION '{target}/_names/{name}.parts'")
        new_columns = True
    elif len(schema.fields) > len(old):
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns(T.StructType(schema.fields[len(old):]))})")
        new_columns = True
    there = _locations(spark, table)
    added = [b for b in parts if b not in there]
    for i in range(0, len(added), 500):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(
            f"PARTITION ({b}) LOCATION '{target}/data/{parts[b]}/{b}'" for b in added[i:i + 500]))
    for b, folder in parts.items():
        if b in there and there[b] != folder:
            spark.sql(f"ALTER TABLE {table} PARTITION ({b}) SET LOCATION '{target}/data/{folder}/{b}'")
    gone = [b for b in there if b not in parts]
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({b})" for b in gone))
    # a catalog may limit the length of a property
    text = json.dumps(parts)
    pieces = [text[i:i + 3500] for i in range(0, len(text), 3500)]
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_STATE}.pieces' = '{len(pieces)}', "
              + ", ".join(f"'{_STATE}.{i}' = '{x}'" for i, x in enumerate(pieces)) + ")")
    if new_columns or not spark.catalog.tableExists(name):
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(_quoted(c) for c in schema.fieldNames())} FROM {table}")


def unregister(spark: SparkSession, target: str, name: str) -> None:
    """Drop a catalog name of the target; its data stays."""
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    spark.sql(f"DROP TABLE IF EXISTS {_parts_name(name)}")
    fs.remove(spark, f"{target}/_names/{name}.name", target)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"

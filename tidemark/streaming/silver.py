"""Bronze -> silver: checkpointed, run-once incremental file streams.

Each run picks up only bronze files this checkpoint has not seen, applies
the table's row transforms and (optionally) the unbounded keyed dedup
"first arrival wins, for ever", appends to the silver parquet table, and
stops (``availableNow``). The schema is remembered per stream and widened
when bronze gains columns; older rows read NULL in new columns.

A column whose type changes ends the run, or (``SilverSpec(rescue=True)``) its
values that do not fit go to ``_rescued_data`` and the rows stay.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace
from functools import reduce
from typing import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fs
from ..config import Namespace
from ..functions.columns import bucket_of, canonical_key, wider_schema
from ..operators.transforms import RESCUED
from ..paths import Layout

ARRIVAL = "__arrival"
BUCKET = "__bucket"
KEY = "__key"
#: merge mode and rescuing tables keep a folder per micro-batch: a replay replaces its own
#: rows. A plain reader of the table's folder sees this column; ours hide it.
BATCH = "__batch"

Transform = Callable[[DataFrame], DataFrame]


@dataclass
class SilverSpec:
    table: str                                  # bronze folder name and silver name
    transform: Transform | None = None
    dedup_keys: Sequence[str] | None = None     # None = no dedup (per-table option)
    max_files_per_trigger: int | None = None
    # rate limit by size instead (bytes, e.g. 64 << 30): a large backlog is
    # drained in several bounded micro-batches (not with max_files_per_trigger)
    max_bytes_per_trigger: int | None = None
    catalog_name: str | None = None             # register the silver table under this name
    schema: T.StructType | None = None          # declared; otherwise inferred and remembered
    # "merge" (default): per micro-batch, the earliest arrival per key (file time, file
    #          name, row) is found with a map-side combined aggregate, then
    #          anti-joined with the history of keys already seen (filtered
    #          map-side by the batch's keys, see ``unseen``). Hot keys collapse
    #          before the shuffle and the winner is deterministic.
    # "state": Spark's stateful dropDuplicates (one RocksDB state entry per
    #          key; within a micro-batch an arbitrary row of a key wins; every
    #          row of a key is shuffled to one task, so a hot key makes one
    #          long task).
    dedup_mode: str = "merge"
    # folders of the key history: a batch reads those its keys fall in
    dedup_buckets: int = 64
    # keep rows whose values do not fit the table's types (``_rescued_data``)
    rescue: bool = False


def _load_doc(spark: SparkSession, spec: SilverSpec, layout: Layout) -> dict:
    text = fs.read_text(spark, layout.silver_schema(spec.table))
    doc = json.loads(text) if text else {}
    return doc if "schema" in doc or not doc else {"schema": doc}   # a bare StructType document


def _checked_dir(spec: SilverSpec, layout: Layout) -> str:
    return f"{layout.root.rstrip('/')}/silver/{spec.table}/checked_files"


def unchecked_files(spark: SparkSession, spec: SilverSpec, layout: Layout) -> DataFrame:
    """(path) of the bronze files whose schema no run has looked at: the listing
    without the list this table keeps."""
    there = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .load(layout.bronze(spec.table)).select("path"))
    done = _checked_dir(spec, layout)
    if not fs.has_data_files(spark, done):
        return there
    return there.join(spark.read.schema("path string").parquet(done).distinct(), "path", "left_anti")


def stream_schema(spark: SparkSession, spec: SilverSpec, layout: Layout) -> T.StructType:
    """Declared schema, or the remembered one widened by the files the stream
    has not processed yet, whatever their dates.

    Inference reads parquet footers (``mergeSchema``), never the data, and
    after the first run only those of new files, so a run costs its new
    files, not the whole bronze history. The document also remembers how the
    table deduplicates; a change would mix two storage forms and needs
    ``reset_silver``.
    """
    doc = _load_doc(spark, spec, layout)
    mode = _mode(spark, spec, doc)
    if spec.schema is not None:
        schema = spec.schema
    else:
        stored = T.StructType.fromJson(doc["schema"]) if "schema" in doc else None
        new = unchecked_files(spark, spec, layout).persist(StorageLevel.MEMORY_AND_DISK)
        names = [r["path"] for r in new.collect()]   # names of new files, as any file scan has them
        current = spark.read.option("mergeSchema", "true").parquet(*names).schema if names else stored
        schema = current if stored is None else wider_schema(stored, current)
        changed = [f.name for f in (stored or schema).fields if schema[f.name].dataType != f.dataType]
        if changed:
            raise ValueError(f"bronze {spec.table!r}: the type of {', '.join(changed)} changed; land it under a "
                             "declared schema (ingest_table(target_schema=...)), rescue=True, or reset_silver the table")
    _save_doc(spark, spec, layout, schema, mode)
    if spec.schema is None:
        if names:
            new.coalesce(1 + len(names) // 100_000).write.mode("append").parquet(_checked_dir(spec, layout))
        new.unpersist()
    return schema


def _save_doc(spark: SparkSession, spec: SilverSpec, layout: Layout, schema: T.StructType, mode: str) -> None:
    fs.write_text(spark, layout.silver_schema(spec.table), json.dumps({"schema": schema.jsonValue(), "dedup": mode}))


def _mode(spark: SparkSession, spec: SilverSpec, doc: dict) -> str:
    """How the table stores and deduplicates; a change needs ``reset_silver``."""
    mode = f"{spec.dedup_mode}:{','.join(spec.dedup_keys)}" if spec.dedup_keys else "none"
    mode += ":rescue" if spec.rescue else ""
    if doc.get("dedup", mode) != mode:
        raise ValueError(f"silver table {spec.table!r} was built with dedup {doc['dedup']!r}, not {mode!r}: "
                         "reset_silver it first")
    return mode


def _save_output_schema(spark: SparkSession, spec: SilverSpec, layout: Layout,
                        schema: T.StructType) -> None:
    fs.write_text(spark, _output_schema_path(spec, layout), schema.json())


def _output_schema_path(spec: SilverSpec, layout: Layout) -> str:
    return f"{layout.root.rstrip('/')}/silver/{spec.table}/output_schema.json"


def output_schema(spark: SparkSession, spec: SilverSpec, layout: Layout) -> T.StructType | None:
    """Schema of the silver table as its last run wrote it (``None`` before
    the first run)."""
    text = fs.read_text(spark, _output_schema_path(spec, layout))
    return T.StructType.fromJson(json.loads(text)) if text else None


def _merge_mode(spec: SilverSpec) -> bool:
    if spec.dedup_mode not in ("state", "merge"):
        raise ValueError(f"dedup_mode must be 'state' or 'merge', not {spec.dedup_mode!r}")
    if spec.rescue and spec.dedup_keys and spec.dedup_mode == "state":
        raise ValueError("a rescuing table deduplicates in 'merge' mode")
    return bool(spec.dedup_keys) and spec.dedup_mode == "merge"


def silver_stream(spark: SparkSession, spec: SilverSpec, layout: Layout) -> DataFrame:
    """The streaming DataFrame of one silver table (source + transforms + dedup).

    In ``merge`` dedup mode the stream carries the arrival order column and
    the dedup itself happens per micro-batch (``first_arrivals``)."""
    # the file source would skip files older than the newest one seen by this age
    reader = spark.readStream.schema(stream_schema(spark, spec, layout)).option("maxFileAge", "36500d")
    if spec.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(spec.max_files_per_trigger))
    if spec.max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(int(spec.max_bytes_per_trigger)))
    df = reader.parquet(layout.bronze(spec.table))
    if _merge_mode(spec):
        df = df.withColumn(ARRIVAL, _arrival())
    if spec.transform is not None:
        df = spec.transform(df)
    if spec.dedup_keys and not _merge_mode(spec):
        # keyed state (RocksDB at scale): one entry per key ever seen
        df = df.dropDuplicates(list(spec.dedup_keys))
    return df


def _arrival() -> Column:
    return F.struct(F.col("_metadata.file_modification_time").alias("t"), F.col("_metadata.file_name").alias("f"),
                    F.col("_metadata.row_index").alias("r"))


# --- keys already seen --------------------------------------------------------
#
# The history is a set of folders, one per batch, each split by key bucket and
# sorted by key hash; every COMPACT_AFTER batches they become one. A small
# numbered file names the live folders and the last batch in them.

HASH = "__hash"
#: the batch's keys reach the history as the slots their hashes fall in: at most
#: so many numbers are broadcast, whatever the size of the batch
SLOTS = 1 << 20
COMPACT_AFTER = 16


def _seen_dir(spec: SilverSpec, layout: Layout) -> str:
    return f"{layout.root.rstrip('/')}/silver/{spec.table}/seen_keys"


def _seen_state(spark: SparkSession, seen_dir: str) -> dict:
    names = [n for n in fs.list_names(spark, f"{seen_dir}/_live") if n.endswith(".json") and not n.startswith(".")]
    if not names:
        return {"number": 0, "folders": [], "batch": -1}
    return json.loads(fs.read_text(spark, f"{seen_dir}/_live/{max(names)}"))


def _seen(spark: SparkSession, seen_dir: str, folders: list[str], schema: T.StructType) -> DataFrame:
    read = [spark.read.schema(schema).option("basePath", f"{seen_dir}/{f}").parquet(f"{seen_dir}/{f}") for f in folders]
    return reduce(DataFrame.unionByName, read)


def unseen(keyed: DataFrame, seen: DataFrame, touched: list[int]) -> DataFrame:
    """Rows of ``keyed`` (one per key, with bucket, hash and key) whose key is not in
    ``seen``. Only the touched buckets of the history are read, and of those only
    keys in a slot of the batch go on: a fixed-size filter, broadcast, with no
    choice by row count. What is shuffled is about the size of the batch."""
    slot = F.pmod(HASH, F.lit(SLOTS)).alias("__slot")
    slots = F.broadcast(keyed.select(slot).distinct())
    near = (seen.where(F.col(BUCKET).isin(touched)).withColumn("__slot", slot)
            .join(slots, "__slot", "left_semi").drop("__slot"))
    return keyed.join(near, [BUCKET, HASH, KEY], "left_anti")


def first_arrivals(spark: SparkSession, batch: DataFrame, batch_id: int, spec: SilverSpec,
                   layout: Layout) -> None:
    """Write the rows of keys never seen before (earliest arrival per key) to a
    folder of this batch, then add those keys to the history. A batch that is
    replayed before its keys are there writes the same rows to the same folder
    again; after that, nothing is left to do."""
    keys = list(spec.dedup_keys or [])
    seen_dir = _seen_dir(spec, layout)
    state = _seen_state(spark, seen_dir)
    if state["batch"] >= batch_id:
        return
    rows_dir = f"{layout.silver_data(spec.table)}/{BATCH}={batch_id}"
    cols = [c for c in batch.columns if c != ARRIVAL]
    key = canonical_key(batch.schema, keys)
    # min_by is combined map-side: a hot key leaves each task as one row
    firsts = (batch.groupBy(*keys)
              .agg(F.min_by(F.struct(*cols), F.col(ARRIVAL)).alias("__w"))
              .select("__w.*")
              .withColumn(BUCKET, bucket_of(batch.schema, keys, spec.dedup_buckets))
              .withColumn(KEY, key).withColumn(HASH, F.xxhash64(KEY))
              .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        touched = [r[BUCKET] for r in firsts.select(BUCKET).distinct().collect()]   # <= buckets
        if not touched:
            return
        history = T.StructType([f for f in firsts.schema.fields if f.name in (KEY, HASH)])
        new = firsts
        if state["folders"]:
            new = unseen(firsts, _seen(spark, seen_dir, state["folders"], history), touched)
        new = new.persist(StorageLevel.MEMORY_AND_DISK)
        _write_batch(new.select(*cols), rows_dir)
        found = new.select(BUCKET, KEY, HASH)
        folders = list(state["folders"])
        if len(folders) >= COMPACT_AFTER:
            found, folders = found.unionByName(_seen(spark, seen_dir, folders, history).select(BUCKET, KEY, HASH)), []
        folder = f"keys-{batch_id}-{uuid.uuid4().hex[:8]}"
        (found.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, HASH)
         .write.option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(f"{seen_dir}/{folder}"))
        new.unpersist()
        state = {"number": state["number"] + 1, "folders": [*folders, folder], "batch": int(batch_id)}
        fs.write_text(spark, f"{seen_dir}/_live/{state['number']:012d}.json", json.dumps(state))
        for old in fs.list_dirs(spark, seen_dir):
            if old.startswith("keys-") and old not in state["folders"]:
                fs.remove(spark, f"{seen_dir}/{old}", seen_dir)
    finally:
        firsts.unpersist()


def _write_batch(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)


# --- rescued values -----------------------------------------------------------

#: columns of a stream of file names (contents are never read)
_FILES = "path string, modificationTime timestamp, length long, content binary"
FILES_PER_BATCH = 10_000


def file_names(spark: SparkSession, spec: SilverSpec, layout: Layout) -> DataFrame:
    """Stream of the names of new bronze files, at most ``FILES_PER_BATCH`` a batch."""
    r = (spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", "*.parquet")
         .option("maxFileAge", "36500d"))
    if spec.max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", str(int(spec.max_bytes_per_trigger)))
    else:
        r = r.option("maxFilesPerTrigger", str(spec.max_files_per_trigger or FILES_PER_BATCH))
    return r.load(layout.bronze(spec.table)).select("path", "modificationTime")


def schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files grouped by schemas that go together. Spark merges the footers of all of
    them in one job; only where types conflict are the files (in order of time)
    halved, so a type that changed once costs a few jobs."""
    try:
        return [(spark.read.option("mergeSchema", "true").parquet(*paths).schema, list(paths))]
    except (PySparkException, Py4JJavaError) as e:
        if len(paths) == 1 or "CANNOT_MERGE" not in str(e):
            raise
    half = len(paths) // 2
    out: list[tuple[T.StructType, list[str]]] = []
    for schema, files in schema_groups(spark, paths[:half]) + schema_groups(spark, paths[half:]):
        if out and all(f.name not in out[-1][0].fieldNames() or out[-1][0][f.name].dataType == f.dataType
                       for f in schema.fields):
            out[-1] = (wider_schema(out[-1][0], schema), out[-1][1] + files)
        else:
            out.append((schema, files))
    return out


def fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns and types of ``schema``, with ``_rescued_data``: a JSON
    object of the values that do not fit their column (NULL there). A number fits
    when it comes back unchanged, a text when it converts."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out, misfits = [], []
    for f in schema.fields:
        if f.name not in have:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c, stored = F.col(f"`{f.name}`"), have[f.name]
        if stored == f.dataType:
            out.append(c)
            continue
        if isinstance(f.dataType, T.StringType) and isinstance(stored, (T.StructType, T.ArrayType, T.MapType)):
            out.append(F.to_json(c).alias(f.name))
            continue
        try:
            value = c.try_cast(f.dataType)
            fits = value.isNotNull() if isinstance(stored, T.StringType) else value.try_cast(stored).eqNullSafe(c)
            df.select(value, fits)
        except PySparkException:   # no conversion between these types
            value, fits = F.lit(None).cast(f.dataType), F.lit(False)
        out.append(F.when(fits, value).alias(f.name))
        misfits.append((c.isNotNull() & ~fits, F.when(~fits, c).alias(f.name)))
    rescued = F.lit(None).cast("string")
    if misfits:
        any_ = reduce(lambda a, b: a | b, [m for m, _ in misfits])
        rescued = F.when(any_, F.to_json(F.struct(*[v for _, v in misfits])))
    return df.select(*out, rescued.alias(RESCUED), *[c for c in (ARRIVAL,) if c in df.columns])


def rescue_batch(spark: SparkSession, names: DataFrame, batch_id: int, spec: SilverSpec, layout: Layout) -> None:
    """One micro-batch of a rescuing table: new files by schema, columns the table
    lacks are added, values that do not fit its types are rescued."""
    paths = [r["path"] for r in names.orderBy("modificationTime", "path").collect()]   # <= FILES_PER_BATCH
    if not paths:
        return
    doc = _load_doc(spark, spec, layout)
    mode = _mode(spark, spec, doc)
    groups = schema_groups(spark, paths)
    schema = spec.schema or (T.StructType.fromJson(doc["schema"]) if "schema" in doc else groups[0][0])
    if spec.schema is None:
        for found, _ in groups:   # types stay as they were first seen
            known = set(schema.fieldNames())
            schema = T.StructType([*schema.fields, *(f for f in found.fields if f.name not in known)])
    _save_doc(spark, spec, layout, schema, mode)
    merge = _merge_mode(spec)
    parts = []
    for found, files in groups:
        df = spark.read.schema(found).parquet(*files)
        parts.append(fitted(df.withColumn(ARRIVAL, _arrival()) if merge else df, schema))
    df = reduce(DataFrame.unionByName, parts)
    if spec.transform is not None:
        df = spec.transform(df)
    if merge:
        first_arrivals(spark, df, batch_id, spec, layout)
    else:
        _write_batch(df, f"{layout.silver_data(spec.table)}/{BATCH}={batch_id}")
    before = output_schema(spark, spec, layout)
    after = T.StructType([f for f in df.schema.fields if f.name != ARRIVAL])
    _save_output_schema(spark, spec, layout, wider_schema(before, after) if before else after)


# --- runs and readers ---------------------------------------------------------

def _by_batch(spec: SilverSpec) -> bool:
    return spec.rescue or _merge_mode(spec)


def run_silver(spark: SparkSession, spec: SilverSpec, layout: Layout,
               namespace: Namespace | None = None) -> DataFrame:
    """Process all pending bronze files, wait for the run to finish, and
    return the silver table as a batch DataFrame. With a namespace the table
    is registered there under its own name, unless the spec names it."""
    spec = named_in(spec, namespace)
    if not fs.has_data_files(spark, layout.bronze(spec.table)):
        return read_silver(spark, spec, layout)
    if _by_batch(spec):
        if spec.rescue:
            _mode(spark, spec, _load_doc(spark, spec, layout))
            df, step = file_names(spark, spec, layout), rescue_batch
        else:
            df, step = silver_stream(spark, spec, layout), first_arrivals
        q = (df.writeStream
             .foreachBatch(lambda b, i: step(spark, b, i, spec, layout))
             .option("checkpointLocation", layout.silver_checkpoint(spec.table))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        if spec.rescue:
            out_schema = output_schema(spark, spec, layout)
        else:
            out_schema = T.StructType([f for f in df.schema.fields if f.name != ARRIVAL])
            _save_output_schema(spark, spec, layout, out_schema)
        if spec.catalog_name:
            # the file sink registers its table itself; here each batch has a
            # folder, so register the parent once and refresh its listing
            if not spark.catalog.tableExists(spec.catalog_name):
                spark.catalog.createTable(spec.catalog_name, path=layout.silver_data(spec.table),
                                          source="parquet", schema=out_schema, recursiveFileLookup="true")
            follow_schema(spark, spec.catalog_name, out_schema)
        return read_silver(spark, spec, layout, schema=out_schema)
    df = silver_stream(spark, spec, layout)
    w = (df.writeStream.format("parquet")
         .outputMode("append")
         .option("checkpointLocation", layout.silver_checkpoint(spec.table))
         .option("path", layout.silver_data(spec.table))
         .trigger(availableNow=True))
    if spec.catalog_name:
        q = w.toTable(spec.catalog_name)
    else:
        q = w.start()
    q.awaitTermination()
    _save_output_schema(spark, spec, layout, df.schema)
    if spec.catalog_name:
        follow_schema(spark, spec.catalog_name, df.schema)
    return read_silver(spark, spec, layout, schema=df.schema)


def named_in(spec: SilverSpec, namespace: Namespace | None) -> SilverSpec:
    """The spec with its catalog name in ``namespace`` (a name of its own stays)."""
    if namespace is None or spec.catalog_name:
        return spec
    return replace(spec, catalog_name=namespace.qualify(spec.table))


def follow_schema(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Columns the table has gained are added to its catalog entry, so that readers
    and streams by name see them."""
    there = set(spark.table(name).columns)
    added = [f for f in schema.fields if f.name not in there]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ("
                  + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added) + ")")
    spark.catalog.refreshTable(name)


def read_silver(spark: SparkSession, spec: SilverSpec, layout: Layout,
                schema: T.StructType | None = None) -> DataFrame:
    """Batch view of a silver table (the sink's commit log decides which
    files are visible, so a half-written batch is never read).

    Files written before a column was added lack it; reading with the
    stream's output schema (remembered by the last run; footers are merged
    only when there is none) shows it as NULL there.
    """
    r = spark.read
    schema = schema or output_schema(spark, spec, layout)
    r = r.schema(schema) if schema is not None else r.option("mergeSchema", "true")
    return r.parquet(layout.silver_data(spec.table)).drop(BATCH)


def table_stream(spark: SparkSession, spec: SilverSpec, layout: Layout) -> DataFrame:
    """Append-only stream over a silver table (the gold staging input); by
    catalog name when the table is registered."""
    if spec.catalog_name and spark.catalog.tableExists(spec.catalog_name):
        return spark.readStream.table(spec.catalog_name)
    schema = output_schema(spark, spec, layout) or read_silver(spark, spec, layout).schema
    return (spark.readStream.schema(schema).option("maxFileAge", "36500d")
            .parquet(layout.silver_data(spec.table)).drop(BATCH))


def reset_silver(spark: SparkSession, spec: SilverSpec, layout: Layout) -> None:
    """Drop the table, its data, checkpoint and remembered schema so the
    next run reloads all of bronze."""
    if spec.catalog_name:
        spark.sql(f"DROP TABLE IF EXISTS {spec.catalog_name}")
    base = f"{layout.root.rstrip('/')}/silver/{spec.table}"
    fs.remove(spark, base, layout.root)

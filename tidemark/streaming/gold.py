"""Keyed gold targets (SCD type 1 / type 2) fed by a stream of changes.

Storage: a parquet folder partitioned by ``__bucket = pmod(xxhash64(keys),
B)`` of the keys in canonical form (``functions.canonical_key``: whole numbers as
bigint, times as one type), so a key keeps its bucket when its column is widened.
Applying a micro-batch recomputes only the buckets its keys fall in:

1. rules (expect-or-drop) and NULL-sequence rejection on the batch;
2. touched buckets = distinct ``__bucket`` of the batch (at most B values),
   with the exact count of applicable rows per bucket;
3. old rows of those buckets (partition-pruned read) are split by key:
   rows of keys the batch does not touch are copied as they are (map-only,
   no shuffle); rows of touched keys + the batch go through the SCD1 /
   SCD2 computation (``tidemark.operators.cdc``). The split is a broadcast
   semi / anti join against the batch's keys, used only when the measured
   row count of the batch bounds that key set below ``broadcast_keys_max``
   and at least half of the stored rows of the touched buckets belong to
   untouched keys; else the touched buckets are recomputed whole (one
   shuffle);
4. the result is written to a new folder (cuts the lineage), and one small
   numbered file then names, for every bucket, the folder that holds it
   (``live``). Readers follow the last such file.

A run that stops anywhere leaves the target as it was before the batch or as
it is after it; a replayed batch is merged again, and SCD1 / SCD2 merges are
idempotent (identical events collapse). The schema of the target is stored
with its folders and widened by every batch: a new column is NULL in older
rows, a batch without a column keeps it, and a changed type becomes the
type that holds both. A key whose form changes (numbers that become texts), or a
column whose older files can't be read in its new type, makes the merge recompute
every bucket once.

Targets registered in the catalog (``register_target``) follow every merge.

Targets with a history exclusion list keep their events, bucketed alike, next
to the data, because collapsed versions have lost the inner sequence points
a late event would need (A@1, A@3, then B@2 must give A, B, A).
"""

from __future__ import annotations

import json

from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fs
from ..functions.columns import bucket_of, conform, key_classes, key_struct, reads_as, wider_schema
from ..operators.cdc import END, START, data_columns, resolve_ties, scd1_latest, scd2_versions
from ..operators.quality import all_rules, rule_column
from ..operators.sequence import HOT_ROWS
from . import live as L
from .live import BUCKET
from .silver import BATCH

FLOW_LOG_SCHEMA = ("flow string, target string, batch_id long, rows_in long, rows_out long, "
                   "null_sequence long, rows_applied long, buckets_touched long, "
                   "split_by_keys boolean, rules map<string,long>")


@dataclass
class CdcFlow:
    """A change flow into a keyed target (the ``auto CDC`` declaration)."""

    target: str
    source: str
    keys: Sequence[str]
    sequence_by: str
    stored_as_scd_type: int = 1
    track_history_except_column_list: Sequence[str] | None = None
    name: str | None = None
    once: bool = False
    expectations: Mapping[str, str] = field(default_factory=dict)
    buckets: int = 64
    bucket_width: int | None = None   # range buckets on a growing integral key
    # type 2: a key with so many events or more is spread over tasks
    hot_rows: int = HOT_ROWS
    # largest batch (applicable rows, counted exactly before the merge) whose
    # key set is broadcast to split old rows into touched / untouched keys
    broadcast_keys_max: int = 1_000_000
    # ... and only when at least this share of the stored rows of the touched
    # buckets belongs to untouched keys (else recomputing them whole is cheaper)
    split_min_untouched: float = 0.5

    @property
    def flow_name(self) -> str:
        return self.name or f"{self.target}_flow"

    def bucket(self, schema: T.StructType):
        return bucket_of(schema, list(self.keys), self.buckets, self.bucket_width)


def read_target(spark: SparkSession, path: str) -> DataFrame:
    """Current contents of a gold target (bucket column hidden)."""
    found = L.rows(spark, path, L.latest(spark, path), "data")
    if found is None:
        raise ValueError(f"nothing has been merged into {path}")
    return found.drop(BUCKET)


def target_exists(spark: SparkSession, path: str) -> bool:
    return bool(L.latest(spark, path).parts.get("data"))


def register_target(spark: SparkSession, path: str, name: str) -> None:
    """Give the target a catalog name that follows its merges: a partitioned table
    ``<name>__parts`` whose partition locations each merge switches, and a view
    ``<name>`` of its columns without the bucket."""
    L.register(spark, path, name)


KEY = "__key"


def _split_by_keys(old: DataFrame, batch_keys: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of keys in the batch, rows of other keys) of the stored rows.

    ``batch_keys`` is a broadcast, size-checked key set: both joins are
    map-side, so the untouched rows are never shuffled.
    """
    k = old.withColumn(KEY, key_struct(keys))
    return (k.join(batch_keys, KEY, "left_semi").drop(KEY),
            k.join(batch_keys, KEY, "left_anti").drop(KEY))


def _batch_key_set(clean: DataFrame, keys: Sequence[str], applied: int,
                   stored: DataFrame | None, flow: "CdcFlow") -> DataFrame | None:
    """The batch's distinct keys (cached), to be broadcast, or ``None`` to
    recompute the touched buckets whole.

    Broadcast only with a proven bound: the key set has at most ``applied``
    rows (an exact count). Splitting pays when many stored rows belong to
    keys the batch does not touch (a day of changes against a long history);
    one job over the stored key columns only counts them (map-side join with
    the broadcast keys, then a global count).
    """
    if stored is None or applied > flow.broadcast_keys_max:
        return None
    key_set = (clean.select(key_struct(keys).alias(KEY)).distinct()
               .persist(StorageLevel.MEMORY_AND_DISK))
    r = (stored.select(key_struct(keys).alias(KEY))
         .join(F.broadcast(key_set.withColumn("__hit", F.lit(True))), KEY, "left")
         .agg(F.count(F.lit(1)).alias("n"), F.count("__hit").alias("hit"))
         .first())
    if r["n"] == 0 or (r["n"] - r["hit"]) < flow.split_min_untouched * r["n"]:
        key_set.unpersist()
        return None
    return key_set


def _with_unchanged(df: DataFrame, unchanged: DataFrame | None) -> DataFrame:
    # REBALANCE on the bucket: one file per bucket normally, AQE splits a
    # skewed (hot-key) bucket into several files instead of one huge task.
    # Unchanged rows keep the bucket they were read from and are written
    # map-only next to the recomputed ones.
    out = df.hint("rebalance", BUCKET)
    return out if unchanged is None else unchanged.unionByName(out, allowMissingColumns=True)


def _bucket_stats(raw: DataFrame, rules: Mapping[str, str], seq: str) -> list[dict]:
    """Rule counters and applicable-row counts per bucket in one aggregate
    job; at most ``buckets`` small rows reach the driver."""
    applicable = all_rules(rules) & F.col(seq).isNotNull()
    cols = [F.count(F.lit(1)).alias("rows_in")]
    cols += [F.count_if(~rule_column(r)).alias(f"failed_{n}") for n, r in rules.items()]
    cols += [F.count_if(all_rules(rules)).alias("rows_out"),
             F.count_if(F.col(seq).isNull()).alias("null_sequence"),
             F.count_if(applicable).alias("applicable")]
    return [r.asDict() for r in raw.groupBy(BUCKET).agg(*cols).collect()]


def _rewrites(live: L.Live, plain: T.StructType | None, schema: T.StructType, keys: Sequence[str]) -> bool:
    """Whether every bucket has to be recomputed: the stored keys are bucketed in
    another form, or stored files can't be read in the widened types."""
    if plain is None:
        return False
    return live.keys != key_classes(schema, keys) or any(
        not reads_as(f.dataType, schema[f.name].dataType) for f in plain.fields)


def _widened(stored: DataFrame, schema: T.StructType) -> DataFrame:
    """Stored rows in the columns and types of ``schema`` (intervals and bucket kept)."""
    extra = [f for f in stored.schema.fields if f.name in (START, END, BUCKET)]
    return conform(stored, T.StructType([*schema.fields, *extra]))


def merge_batch(spark: SparkSession, batch: DataFrame, flow: CdcFlow, target_path: str,
                batch_id: int, log: bool = True) -> dict:
    """Apply one batch of change events to the target. Returns batch metrics."""
    keys, seq = list(flow.keys), flow.sequence_by
    keep_events = flow.stored_as_scd_type == 2 and flow.track_history_except_column_list is not None
    live = L.latest(spark, target_path)

    rules = dict(flow.expectations)
    batch = batch.drop(BATCH)
    cols = data_columns(batch)
    # stored columns first; the batch's new ones behind them
    stored = live.schema("events" if keep_events else "data")
    plain = T.StructType([f for f in stored.fields if f.name not in (START, END)]) if stored else None
    incoming = batch.select(*cols)
    schema = wider_schema(plain, incoming.schema) if plain else incoming.schema
    whole = _rewrites(live, plain, schema, keys)
    bucket = flow.bucket(schema)
    raw = (conform(incoming, schema)
           .withColumn(BUCKET, bucket)
           .persist(StorageLevel.MEMORY_AND_DISK))
    cached = [raw]
    try:
        per_bucket = _bucket_stats(raw, rules, seq)
        touched = sorted(r[BUCKET] for r in per_bucket if r["applicable"] > 0)
        clean = raw.where(all_rules(rules) & F.col(seq).isNotNull())
        applied = sum(int(r["applicable"]) for r in per_bucket)
        unchanged, key_set = None, None
        if touched:
            # the rows a merge recomputes: stored events (exclusion list) or versions
            base = L.rows(spark, target_path, live, "events" if keep_events else "data", None if whole else touched)
            base = None if base is None else _widened(base, schema)
            key_set = None if whole else _batch_key_set(clean, keys, applied, base, flow)
            if key_set is not None:
                cached.append(key_set)
                key_set = F.broadcast(key_set)
            staged = []
            if keep_events:
                old_ev, kept_ev = base, None
                if old_ev is not None and key_set is not None:
                    old_ev, kept_ev = _split_by_keys(old_ev, key_set, keys)
                events = clean if old_ev is None else old_ev.unionByName(clean)
                events = resolve_ties(events.drop(BUCKET), keys, seq)
                staged.append(L.stage(_with_unchanged(events.withColumn(BUCKET, bucket), kept_ev), target_path, "events"))
                staged_events = L.staged_rows(spark, target_path, staged[0]).drop(BUCKET)
                if key_set is not None:
                    staged_events, _ = _split_by_keys(staged_events, key_set, keys)
                    old = L.rows(spark, target_path, live, "data", touched)
                    if old is not None:
                        _, unchanged = _split_by_keys(_widened(old, schema), key_set, keys)
                result = scd2_versions(staged_events, keys, seq,
                                       flow.track_history_except_column_list, flow.hot_rows, resolved=True)
            else:
                old = base
                events = clean.drop(BUCKET)
                if old is not None:
                    if key_set is not None:
                        old, unchanged = _split_by_keys(old, key_set, keys)
                    # stored rows are events again (a version row is its event)
                    events = old.drop(START, END, BUCKET).unionByName(events)
                if flow.stored_as_scd_type == 1:
                    result = scd1_latest(events, keys, seq)
                else:
                    result = scd2_versions(events, keys, seq, None, flow.hot_rows)
            staged.append(L.stage(_with_unchanged(result.withColumn(BUCKET, bucket), unchanged), target_path, "data"))
            L.publish(spark, target_path, live, staged, flow.flow_name, batch_id, key_classes(schema, keys), whole)
    finally:
        for df in cached:
            df.unpersist()
    total = {k: sum(int(r[k]) for r in per_bucket) for k in
             ["rows_in", "rows_out", "null_sequence", "applicable"] + [f"failed_{n}" for n in rules]}
    metrics = {
        "flow": flow.flow_name, "target": flow.target, "batch_id": int(batch_id),
        "rows_in": total["rows_in"], "rows_out": total["rows_out"],
        "null_sequence": total["null_sequence"], "rows_applied": total["applicable"],
        "buckets_touched": len(touched), "rewritten": whole and bool(touched),
        "split_by_keys": key_set is not None,
        "rules": {n: total[f"failed_{n}"] for n in rules},
    }
    if log:
        fs.write_text(spark, f"{target_path}/_log/{flow.flow_name}-{int(batch_id):012d}.json",
                      json.dumps(metrics) + "\n")
    return metrics


def flow_log(spark: SparkSession, target_path: str) -> DataFrame:
    """Per-batch metrics of every flow into a target (rules, rows applied)."""
    return spark.read.schema(FLOW_LOG_SCHEMA).json(f"{target_path}/_log")


def upsert_report(spark: SparkSession, target_paths: Mapping[str, str]) -> DataFrame:
    """Rows applied per target over all batches (the run view's "records
    upserted"), plus rows dropped by rules and rows without a sequence."""
    logs = [flow_log(spark, p) for p in target_paths.values() if fs.exists(spark, f"{p}/_log")]
    if not logs:
        return spark.createDataFrame([], "target string, batches long, rows_upserted long, "
                                         "rows_dropped long, null_sequence long")
    df = logs[0]
    for other in logs[1:]:
        df = df.unionByName(other)
    return (df.groupBy("target")
            .agg(F.count(F.lit(1)).alias("batches"),
                 F.sum("rows_applied").alias("rows_upserted"),
                 F.sum(F.col("rows_in") - F.col("rows_out")).alias("rows_dropped"),
                 F.sum("null_sequence").alias("null_sequence")))


def reset_target(spark: SparkSession, target_path: str, checkpoint: str | None, guard_root: str) -> None:
    """Delete a target and its flow checkpoint so the next run rebuilds it."""
    fs.remove(spark, target_path, guard_root)
    if checkpoint:
        fs.remove(spark, checkpoint, guard_root)


def run_flow(spark: SparkSession, source: DataFrame, flow: CdcFlow, target_path: str,
             checkpoint: str) -> None:
    """Drain everything pending in ``source`` into the target and stop.

    Streaming source: ``foreachBatch`` + ``availableNow`` trigger, progress in
    ``checkpoint`` (``once=True`` adds nothing: a row is applied once anyway).
    Batch source with ``once=True``: a one-shot backfill, applied at most once
    per checkpoint folder.
    """
    if not source.isStreaming:
        marker = f"{checkpoint}/_once_done"
        if flow.once and fs.exists(spark, marker):
            return
        merge_batch(spark, source, flow, target_path, batch_id=0)
        if flow.once:
            fs.write_text(spark, marker, "done")
        return

    def apply(batch_df: DataFrame, batch_id: int) -> None:
        merge_batch(spark, batch_df, flow, target_path, batch_id)

    q = (source.writeStream
         .queryName(f"{flow.flow_name}_{abs(hash(target_path)) % 10**8}")
         .foreachBatch(apply)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()

"""Declared datasets and change flows, run in dependency order.

The names follow Spark's declarative-pipelines vocabulary:

    reg = Registry()

    @reg.table
    @reg.expect_all_or_drop({"rule_1": "user_id IS NOT NULL"})
    def events_clean(spark):
        return spark.readStream...               # any streaming DataFrame

    @reg.table                                    # built from another declared table
    def purchases(spark):
        return reg.read_stream(spark, "events_clean").where("event_type = 'purchase'")

    reg.create_streaming_table("last_purchase", expect_all_or_drop={...})
    reg.create_auto_cdc_flow(target="last_purchase", source="purchases",
                             keys=["user_id"], sequence_by="ts")
    reg.run(spark, layout, namespace=Namespace(schema="gold"))

``run`` materialises every declared table, then drains each flow from its source
table into its keyed target with ``foreachBatch`` merges. A table that another one
reads (``read_stream``, ``read``) is built the moment it is asked for, so no order has
to be declared. A streaming DataFrame becomes an append-only table (checkpointed,
``availableNow``); a batch DataFrame becomes a snapshot per run: ``read`` sees the
last one, ``read_stream`` and flows get each run's rows once.

Rule counters of tables (per micro-batch or snapshot) and of targets (per merge) are
kept in one metrics table (``dataset_metrics``). With a namespace, tables and
targets get a catalog name there.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field
from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from .. import fs
from ..config import Namespace
from ..operators.quality import expect_all_or_drop, metric_columns, observe_rules
from ..operators.sequence import HOT_ROWS
from ..paths import Layout
from ..streaming.gold import CdcFlow, flow_log, read_target, register_target, run_flow, target_exists
from ..streaming.silver import BATCH, follow_schema

METRICS_SCHEMA = "dataset string, batch long, rows_in long, rows_out long, failed map<string,long>"

DatasetFn = Callable[[SparkSession], DataFrame]


@dataclass
class _Dataset:
    name: str
    fn: DatasetFn
    expectations: dict = field(default_factory=dict)
    reads: tuple[str, ...] = ()


@dataclass
class _Target:
    name: str
    expectations: dict = field(default_factory=dict)
    buckets: int = 64
    bucket_width: int | None = None
    broadcast_keys_max: int = 1_000_000
    hot_rows: int = HOT_ROWS


class _Progress(StreamingQueryListener):
    """Keeps a stream's observed metrics of every micro-batch (the query itself
    remembers the last hundred only)."""

    def __init__(self, name: str):
        self.name, self.seen = name, {}

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def onQueryProgress(self, event):
        got = event.progress.observedMetrics.get(self.name)
        if got is not None:
            self.seen[event.progress.batchId] = got.asDict()


class Registry:
    def __init__(self) -> None:
        self.datasets: dict[str, _Dataset] = {}
        self.targets: dict[str, _Target] = {}
        self.flows: list[CdcFlow] = []
        self.metrics: dict[str, list[dict]] = {}
        self._schemas: dict[str, T.StructType] = {}
        self._layout: Layout | None = None
        self._namespace: Namespace | None = None
        self._built: set[str] = set()
        self._building: list[str] = []

    # -- declarations -------------------------------------------------------
    def table(self, fn: DatasetFn | None = None, *, name: str | None = None, reads: Sequence[str] = ()):
        """Declare a table; ``reads`` names the declared tables it is built from."""
        def wrap(f: DatasetFn) -> DatasetFn:
            rules = dict(getattr(f, "_expectations", {}))
            self.datasets[name or f.__name__] = _Dataset(name or f.__name__, f, rules, tuple(reads))
            return f
        return wrap(fn) if fn is not None else wrap

    @staticmethod
    def expect_all_or_drop(rules: Mapping[str, str]):
        def wrap(f: DatasetFn) -> DatasetFn:
            merged = dict(getattr(f, "_expectations", {}))
            merged.update(rules)
            f._expectations = merged  # type: ignore[attr-defined]
            return f
        return wrap

    def create_streaming_table(self, name: str, expect_all_or_drop: Mapping[str, str] | None = None,
                               buckets: int = 64, bucket_width: int | None = None,
                               broadcast_keys_max: int = 1_000_000, hot_rows: int = HOT_ROWS) -> None:
        """Declare a keyed target. ``buckets`` hash buckets by default;
        ``bucket_width`` switches to range buckets on a growing integral key;
        ``broadcast_keys_max`` bounds the batch key set a merge may broadcast;
        a key with ``hot_rows`` events or more is spread over tasks (type 2)."""
        self.targets[name] = _Target(name, dict(expect_all_or_drop or {}), buckets, bucket_width,
                                     broadcast_keys_max, hot_rows)

    def create_auto_cdc_flow(self, target: str, source: str, keys: Sequence[str], sequence_by: str,
                             stored_as_scd_type: int = 1,
                             track_history_except_column_list: Sequence[str] | None = None,
                             name: str | None = None, once: bool = False) -> CdcFlow:
        if target not in self.targets:
            raise ValueError(f"declare the target first: create_streaming_table({target!r})")
        t = self.targets[target]
        flow = CdcFlow(target=target, source=source, keys=list(keys), sequence_by=sequence_by,
                       stored_as_scd_type=stored_as_scd_type,
                       track_history_except_column_list=(list(track_history_except_column_list)
                                                         if track_history_except_column_list is not None
                                                         else None),
                       name=name, once=once, expectations=t.expectations, buckets=t.buckets,
                       bucket_width=t.bucket_width, broadcast_keys_max=t.broadcast_keys_max,
                       hot_rows=t.hot_rows)
        if any(f.flow_name == flow.flow_name for f in self.flows):
            raise ValueError(f"a flow named {flow.flow_name!r} exists: flows share nothing, give each a name")
        self.flows.append(flow)
        return flow

    # -- execution ----------------------------------------------------------
    def _dataset_path(self, layout: Layout, name: str) -> str:
        return f"{layout.gold(name)}/data"

    def _materialise(self, spark: SparkSession, layout: Layout, ds: _Dataset) -> None:
        df = ds.fn(spark)
        if BATCH in df.columns:
            df = df.drop(BATCH)
        if df.isStreaming:
            counts = self._append(spark, layout, ds, df)
        else:
            counts = self._snapshot(spark, layout, ds, df)
        self.metrics[ds.name] = [counts[i] for i in sorted(counts)]
        for batch, c in counts.items():
            rules = {n: int(c[f"failed_{n}"]) for n in ds.expectations}
            doc = {"dataset": ds.name, "batch": int(batch), "rows_in": int(c["rows_in"]), "rows_out": int(c["rows_out"]), "failed": rules}
            fs.write_text(spark, f"{_metrics_path(layout)}/{ds.name}-{int(batch):012d}.json", json.dumps(doc) + "\n")
        fs.write_text(spark, self._schema_path(layout, ds.name), df.schema.json())
        self._schemas[ds.name] = df.schema
        if self._namespace is not None:
            self._register(spark, layout, ds.name, df.isStreaming)

    def _append(self, spark: SparkSession, layout: Layout, ds: _Dataset, df: DataFrame) -> dict[int, dict]:
        """Append what is pending; the counters of every micro-batch."""
        df = expect_all_or_drop(observe_rules(df, ds.expectations, f"dq_{ds.name}"), ds.expectations)
        progress = _Progress(f"dq_{ds.name}")
        spark.streams.addListener(progress)
        try:
            q = (df.writeStream.format("parquet").outputMode("append")
                 .option("checkpointLocation", layout.gold_checkpoint(f"table_{ds.name}"))
                 .option("path", self._dataset_path(layout, ds.name))
                 .trigger(availableNow=True).start())
            q.awaitTermination()
            # the listener is called a moment after the query has ended
            last = max((p["batchId"] for p in q.recentProgress if f"dq_{ds.name}" in p.get("observedMetrics", {})),
                       default=None)
            until = time.monotonic() + 10
            while last is not None and last not in progress.seen and time.monotonic() < until:
                time.sleep(0.05)
        finally:
            spark.streams.removeListener(progress)
        return progress.seen

    def _snapshots(self, spark: SparkSession, layout: Layout, name: str) -> list[int]:
        return sorted(int(d.split("=")[1]) for d in fs.list_dirs(spark, self._dataset_path(layout, name))
                      if d.startswith(f"{BATCH}=") and fs.exists(spark, f"{self._dataset_path(layout, name)}/{d}/_SUCCESS"))

    def _snapshot(self, spark: SparkSession, layout: Layout, ds: _Dataset, df: DataFrame) -> dict[int, dict]:
        """The table as of this run in a folder of its own, counted while it is written;
        the one before stays for its readers, older ones go."""
        there = self._snapshots(spark, layout, ds.name)
        n = there[-1] + 1 if there else 0
        seen = Observation(f"dq_{ds.name}_{n}")
        out = expect_all_or_drop(df.observe(seen, *metric_columns(ds.expectations)), ds.expectations)
        path = self._dataset_path(layout, ds.name)
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{BATCH}={n}")
        for old in there[:-1]:
            fs.remove(spark, f"{path}/{BATCH}={old}", path)
        return {n: seen.get}

    def _register(self, spark: SparkSession, layout: Layout, name: str, appended: bool) -> None:
        """A catalog name of a table: all rows of an appended one, the last snapshot of
        a batch one."""
        full, path, schema = self._namespace.qualify(name), self._dataset_path(layout, name), self._schemas[name]
        if not appended:
            path = f"{path}/{BATCH}={self._snapshots(spark, layout, name)[-1]}"
            spark.sql(f"DROP TABLE IF EXISTS {full}")   # external: the files stay
        if not spark.catalog.tableExists(full):
            spark.catalog.createTable(full, path=path, source="parquet", schema=schema)
        follow_schema(spark, full, schema)

    def _schema_path(self, layout: Layout, name: str) -> str:
        return f"{layout.gold(name)}/schema.json"

    def _need(self, spark: SparkSession, name: str) -> None:
        """Build a declared table unless this run has built it."""
        if name in self._built:
            return
        if name not in self.datasets:
            raise ValueError(f"{name!r} is not a declared table")
        if self._layout is None:
            raise ValueError(f"{name!r} is read outside a run")
        if name in self._building:
            raise ValueError("declared tables read each other: " + " -> ".join((*self._building, name)))
        self._building.append(name)
        try:
            self._materialise(spark, self._layout, self.datasets[name])
        finally:
            self._building.pop()
        self._built.add(name)

    def read_stream(self, spark: SparkSession, name: str) -> DataFrame:
        """Stream of a declared table, for the tables that read it: rows appended to it,
        or the rows of every new snapshot."""
        self._need(spark, name)
        return (spark.readStream.schema(self._schemas[name]).option("maxFileAge", "36500d")
                .parquet(self._dataset_path(self._layout, name)).drop(BATCH))

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """A declared table as it is now (the last snapshot of a batch table)."""
        self._need(spark, name)
        path = self._dataset_path(self._layout, name)
        there = self._snapshots(spark, self._layout, name)
        return spark.read.schema(self._schemas[name]).parquet(f"{path}/{BATCH}={there[-1]}" if there else path)

    def run(self, spark: SparkSession, layout: Layout, namespace: Namespace | None = None) -> dict[str, DataFrame]:
        """Materialise the declared tables, then run the flows."""
        self._layout, self._namespace, self._built = layout, namespace, set()
        for name in (*self.datasets, *(f.source for f in self.flows)):
            for r in self.datasets[name].reads if name in self.datasets else ():
                self._need(spark, r)
            self._need(spark, name)
        out: dict[str, DataFrame] = {}
        for flow in self.flows:
            if not fs.has_data_files(spark, self._dataset_path(layout, flow.source)):
                continue
            src = self.read(spark, flow.source) if flow.once else self.read_stream(spark, flow.source)
            run_flow(spark, src, flow, layout.gold(flow.target),
                     layout.gold_checkpoint(flow.flow_name))
        for t in self.targets:
            if target_exists(spark, layout.gold(t)):
                out[t] = read_target(spark, layout.gold(t))
                if namespace is not None:
                    register_target(spark, layout.gold(t), namespace.qualify(t))
        return out

    def dataset_metrics(self, spark: SparkSession, layout: Layout) -> DataFrame:
        """One row per (dataset, batch) of all runs: rows seen, rows kept and rows that
        broke each rule, for declared tables and for targets."""
        parts = []
        if fs.exists(spark, _metrics_path(layout)):
            parts.append(spark.read.schema(METRICS_SCHEMA).json(_metrics_path(layout)))
        for t in self.targets:
            if fs.exists(spark, f"{layout.gold(t)}/_log"):
                parts.append(flow_log(spark, layout.gold(t)).select(
                    F.col("target").alias("dataset"), F.col("batch_id").alias("batch"), "rows_in", "rows_out",
                    F.col("rules").alias("failed")))
        return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], METRICS_SCHEMA)


def _metrics_path(layout: Layout) -> str:
    return layout.gold("_metrics")

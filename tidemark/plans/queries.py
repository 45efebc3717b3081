"""Named end-to-end queries over the driver tables, each with a DuckDB oracle.

Every query reads whole tables from ``sf_dir`` (or what the engine derives
from them: bronze files, silver streams, gold targets written under a fresh
scratch folder of the shared work root) and returns a lazy DataFrame.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import JoinSpec, Namespace, SourceTable
from ..functions.columns import band, drop_columns, replace_all, upper
from ..operators.cdc import closed_versions, lineage, scd1_latest, scd2_versions
from ..operators.quality import duplicate_keys, expect_all_or_drop, expectation_metrics
from ..operators.star import star_join
from ..operators.transforms import drop_rescued, with_constants
from ..paths import Layout
from ..session import scratch
from ..sources.extract import high_water_mark
from ..sources.relational import frame_reader, parquet_reader
from ..sources.watermark import watermark_history, write_watermark
from ..sinks.bronze import append_bronze
from ..streaming.gold import CdcFlow, merge_batch, read_target, register_target, run_flow, upsert_report
from ..streaming.silver import SilverSpec, read_silver, reset_silver, run_silver, table_stream
from .declare import Registry
from .ingest import NO_DATA, ingest_all, ingest_table, read_rejects

Query = Callable[[SparkSession, str], DataFrame]

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed parameters of the checks below (marks, backfill date, rules, keys).
ORDERS_LOW_MARK = "1998-01-01 00:00:00.000000"
ORDERS_STORED_MARK = "2000-01-01 00:00:00.000000"
ORDERS_BACKFILL_FROM = "1997-06-30"
ORDERS_FIRST_RUN_CAP = "1998-12-31"
LOOKBACK = "400 days"
MARK_CAPS = ("1996-12-31", "1997-12-31", ORDERS_FIRST_RUN_CAP)
EVENT_RULES = {
    "rule_1": "user_id IS NOT NULL",
    "known_type": "event_type IN ('click', 'view', 'purchase', 'signup')",
}
UNTRACKED = ["ts", "value", "event_id", "props"]
LINEAGE_KEYS = (46, 5)
TARGET_RULES = {"bought": "event_type = 'purchase' AND value > 0"}
SIZE_BANDS = ((15, "low"), (30, "medium"))
SIZE_DEFAULT = "high"
ORDER_BUCKET_WIDTH = 8192


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _paths(sf_dir: str) -> dict[str, str]:
    return {t: f"{sf_dir}/{t}.parquet" for t in TABLES}


ORDERS = SourceTable(table="orders", cdc_col="o_orderdate", keys=("o_orderkey",))
EVENTS = SourceTable(table="events", cdc_col="ts", keys=("event_id",))
LINEITEM = SourceTable(table="lineitem", cdc_col="l_shipdate")


# --- extraction ---------------------------------------------------------------

def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    lay = Layout(scratch(spark, "incremental_extract"))
    write_watermark(spark, lay.watermark("orders"), ORDERS_LOW_MARK, "r0", "seed")
    ingest_table(spark, ORDERS, parquet_reader(spark, _paths(sf_dir)), lay)
    return spark.read.parquet(lay.bronze("orders"))


def backfill_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    lay = Layout(scratch(spark, "backfill_extract"))
    write_watermark(spark, lay.watermark("orders"), ORDERS_STORED_MARK, "r0", "seed")
    r = ingest_table(spark, ORDERS, parquet_reader(spark, _paths(sf_dir)), lay,
                     from_date=ORDERS_BACKFILL_FROM)
    assert r.low_mark == ORDERS_BACKFILL_FROM
    return spark.read.parquet(lay.bronze("orders"))


def extract_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run 1 sees the source as it was at an earlier time, run 2 the whole
    table, run 3 no change: bronze must hold every row exactly once."""
    lay = Layout(scratch(spark, "extract_two_runs"))
    orders = table(spark, sf_dir, "orders")
    early = orders.where(F.col("o_orderdate") <= F.to_timestamp_ntz(F.lit(ORDERS_FIRST_RUN_CAP)))
    ingest_table(spark, ORDERS, frame_reader({"orders": early}), lay)
    ingest_table(spark, ORDERS, frame_reader({"orders": orders}), lay)
    third = ingest_table(spark, ORDERS, frame_reader({"orders": orders}), lay)
    assert third.status == NO_DATA
    return spark.read.parquet(lay.bronze("orders"))


def late_rows_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh order is committed after the first run; those up to ``LOOKBACK``
    below the mark of that run are delivered by the second, and nothing twice."""
    lay = Layout(scratch(spark, "late_rows_lookback"))
    orders = table(spark, sf_dir, "orders")
    cfg = SourceTable(table="orders", cdc_col="o_orderdate", keys=("o_orderkey",), lookback=LOOKBACK)
    early = orders.where(F.col("o_orderdate") <= F.to_timestamp_ntz(F.lit(ORDERS_FIRST_RUN_CAP))).where("o_orderkey % 7 > 0")
    ingest_table(spark, cfg, frame_reader({"orders": early}), lay)
    ingest_table(spark, cfg, frame_reader({"orders": orders}), lay)
    # the new mark's window holds nothing that was not delivered, but rows that were late before
    ingest_table(spark, cfg, frame_reader({"orders": orders}), lay)
    return spark.read.parquet(lay.bronze("orders"))


def watermark_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_water_mark(table(spark, sf_dir, "orders"), "o_orderdate")


def ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lay = Layout(scratch(spark, "ingest_report"))
    rep = ingest_all(spark, [ORDERS, EVENTS, LINEITEM], parquet_reader(spark, _paths(sf_dir)), lay)
    return rep.select("table_name", "status", "rows_read", "watermark")


# --- silver row transforms ------------------------------------------------------

def drop_columns_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_columns(table(spark, sf_dir, "orders"), ["_rescued_data", "o_orderstatus", "o_comment"])


def upper_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumn("c_name", upper("c_name"))


def regexp_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.select("o_orderkey",
                     F.col("o_orderdate").cast("date").cast("string").alias("order_day"),
                     "o_orderpriority")
            .withColumn("order_day", replace_all("order_day", "-", " "))
            .withColumn("o_orderpriority", replace_all("o_orderpriority", "-", " ")))


def range_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", "p_size", band("p_size", SIZE_BANDS, SIZE_DEFAULT).alias("size_flag"))


# --- streams --------------------------------------------------------------------

def _event_cuts(spark: SparkSession, events: DataFrame, parts: int) -> list[str]:
    """Cut points splitting the event time range in equal parts (2 scalars
    come back to the driver)."""
    r = events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    step = (r["hi"] - r["lo"]) / parts
    return [(r["lo"] + step * i).strftime("%Y-%m-%d %H:%M:%S.%f") for i in range(1, parts)]


def _capped(df: DataFrame, col: str, cap: str) -> DataFrame:
    return df.where(F.col(col) <= F.to_timestamp_ntz(F.lit(cap)))


def stream_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three ingest runs over a growing source, a silver run after each."""
    lay = Layout(scratch(spark, "stream_copy"))
    ev = table(spark, sf_dir, "events")
    spec = SilverSpec(table="events", transform=drop_rescued)
    for cap in _event_cuts(spark, ev, 3) + [None]:
        state = ev if cap is None else _capped(ev, "ts", cap)
        ingest_table(spark, EVENTS, frame_reader({"events": state}), lay)
        run_silver(spark, spec, lay)
    return read_silver(spark, spec, lay)


def _daily_runs(spark: SparkSession, sf_dir: str, name: str) -> tuple[Layout, DataFrame]:
    """One ingest run per day of events (the source grows day by day, and holds its
    rows in order of time); the day list is bounded by the time range, not the row count."""
    lay = Layout(scratch(spark, name))
    ev = table(spark, sf_dir, "events")
    days = [r["d"] for r in ev.select(F.to_date("ts").alias("d")).distinct().orderBy("d").collect()]
    for d in days:
        cap = f"{d.isoformat()} 23:59:59.999999"
        ingest_table(spark, EVENTS, frame_reader({"events": _capped(ev, "ts", cap)}), lay)
    return lay, ev


def stream_first_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily ingest runs; silver keeps the first arrival of every user
    (Spark's stateful dedup; one file per micro-batch so that arrival order
    is the day order)."""
    lay, _ = _daily_runs(spark, sf_dir, "stream_first_arrival")
    spec = SilverSpec(table="events", transform=drop_rescued, dedup_keys=["user_id"],
                      dedup_mode="state", max_files_per_trigger=1)
    return run_silver(spark, spec, lay)


def stream_first_arrival_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same result with the skew-safe merge dedup: all 30 daily files in one
    micro-batch, earliest file per user wins."""
    lay, _ = _daily_runs(spark, sf_dir, "stream_first_arrival_merge")
    spec = SilverSpec(table="events", transform=drop_rescued, dedup_keys=["user_id"],
                      dedup_mode="merge")
    return run_silver(spark, spec, lay)


# --- quality --------------------------------------------------------------------

def expect_or_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expect_all_or_drop(table(spark, sf_dir, "events"), EVENT_RULES)


def expect_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expectation_metrics(table(spark, sf_dir, "events"), EVENT_RULES)


def key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- change application -----------------------------------------------------------

def _flow(scd: int, except_cols=None, buckets: int = 16) -> CdcFlow:
    return CdcFlow(target="events_gold", source="events_silver", keys=["user_id"],
                   sequence_by="ts", stored_as_scd_type=scd,
                   track_history_except_column_list=except_cols, buckets=buckets)


def _shuffled_batches(df: DataFrame) -> list[DataFrame]:
    a, b, c = df.randomSplit([1.0, 1.0, 1.0], seed=42)
    return [c, a, b]


def scd1_latest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "scd1_latest")
    run_flow(spark, table(spark, sf_dir, "events"), _flow(1), root, f"{root}/_cp")
    return read_target(spark, root)


def scd1_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "scd1_out_of_order")
    flow = _flow(1)
    for i, b in enumerate(_shuffled_batches(table(spark, sf_dir, "events"))):
        merge_batch(spark, b, flow, root, i)
    return read_target(spark, root)


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full chain: ingest runs -> silver stream -> SCD2 flow after each run."""
    lay = Layout(scratch(spark, "scd2_history"))
    ev = table(spark, sf_dir, "events")
    spec = SilverSpec(table="events", transform=drop_rescued)
    flow = _flow(2)
    for cap in _event_cuts(spark, ev, 3) + [None]:
        state = ev if cap is None else _capped(ev, "ts", cap)
        ingest_table(spark, EVENTS, frame_reader({"events": state}), lay)
        run_silver(spark, spec, lay)
        run_flow(spark, table_stream(spark, spec, lay), flow, lay.gold(flow.target),
                 lay.gold_checkpoint(flow.flow_name))
    return read_target(spark, lay.gold(flow.target))


def _scd2_shuffled(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    root = scratch(spark, name)
    flow = _flow(2)
    for i, b in enumerate(_shuffled_batches(table(spark, sf_dir, "events"))):
        merge_batch(spark, b, flow, root, i)
    return read_target(spark, root)


def scd2_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd2_shuffled(spark, sf_dir, "scd2_out_of_order")


def scd2_except_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only event_type opens a version; all else is updated in place."""
    root = scratch(spark, "scd2_except_columns")
    flow = _flow(2, except_cols=UNTRACKED)
    ev = table(spark, sf_dir, "events")
    for i, b in enumerate(_shuffled_batches(ev)):
        merge_batch(spark, b, flow, root, i)
    return read_target(spark, root)


def scd2_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closed_versions(_scd2_shuffled(spark, sf_dir, "scd2_closed"))


def scd2_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage(_scd2_shuffled(spark, sf_dir, "scd2_lineage"), "user_id", LINEAGE_KEYS)


def _daily_merge(spark: SparkSession, sf_dir: str, name: str, flow: CdcFlow,
                 source: str = "events", seq: str = "ts") -> DataFrame:
    """A target holding the history before the last day, then the last day's
    rows merged as one batch: the daily incremental case. When the day
    touches few keys (orders by customer), the merge recomputes only those
    and copies the rest; when it touches most keys (events by user), it
    recomputes the touched buckets whole."""
    root = scratch(spark, name)
    src = table(spark, sf_dir, source)
    cut = src.agg(F.date_trunc("day", F.max(seq)).alias("d")).first()["d"]   # one value
    before = F.col(seq) < F.lit(cut)
    merge_batch(spark, src.where(before), flow, root, 0)
    merge_batch(spark, src.where(~before | F.col(seq).isNull()), flow, root, 1)
    return read_target(spark, root)


def _orders_flow(scd: int) -> CdcFlow:
    return CdcFlow(target="orders_by_customer", source="orders", keys=["o_custkey"],
                   sequence_by="o_orderdate", stored_as_scd_type=scd, buckets=16)


def scd1_orders_daily_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_merge(spark, sf_dir, "scd1_orders_daily_merge", _orders_flow(1),
                        source="orders", seq="o_orderdate")


def scd2_orders_daily_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_merge(spark, sf_dir, "scd2_orders_daily_merge", _orders_flow(2),
                        source="orders", seq="o_orderdate")


def scd1_daily_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_merge(spark, sf_dir, "scd1_daily_merge", _flow(1))


def scd2_daily_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_merge(spark, sf_dir, "scd2_daily_merge", _flow(2))


def scd2_except_daily_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_merge(spark, sf_dir, "scd2_except_daily_merge", _flow(2, except_cols=UNTRACKED))


def scd2_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch form of SCD2 (no target), e.g. to rebuild a target from staging."""
    return scd2_versions(table(spark, sf_dir, "events"), ["user_id"], "ts")


def scd1_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd1_latest(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate")


def declared_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declarative form: staging table with a rule -> target with the same
    rule -> SCD2 change flow."""
    lay = Layout(scratch(spark, "declared_flows"))
    ev = table(spark, sf_dir, "events")
    ingest_table(spark, EVENTS, frame_reader({"events": ev}), lay)
    reg = Registry()
    schema = ev.schema

    @reg.table
    @reg.expect_all_or_drop(EVENT_RULES)
    def events_stg(s: SparkSession) -> DataFrame:
        return s.readStream.schema(schema).parquet(lay.bronze("events"))

    reg.create_streaming_table("events_dim", expect_all_or_drop=EVENT_RULES, buckets=16)
    reg.create_auto_cdc_flow(target="events_dim", source="events_stg", keys=["user_id"],
                             sequence_by="ts", stored_as_scd_type=2)
    return reg.run(spark, lay)["events_dim"]


def scd2_added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of three events arrive without ``props``, then the others with it,
    then a few again without: the column appears, and stays."""
    root = scratch(spark, "scd2_added_column")
    ev, flow = table(spark, sf_dir, "events"), _flow(2)
    late = F.col("event_id") % 3 == 0
    merge_batch(spark, ev.where(~late & (F.col("event_id") % 100 > 0)).drop("props"), flow, root, 0)
    merge_batch(spark, ev.where(late), flow, root, 1)
    merge_batch(spark, ev.where(~late & (F.col("event_id") % 100 == 0)).drop("props"), flow, root, 2)
    return read_target(spark, root)


def _drifting_keys(spark: SparkSession, sf_dir: str, name: str, flow: CdcFlow, kinds: list[str]) -> DataFrame:
    """Orders merged in date slices, the customer key in another type each time."""
    root = scratch(spark, name)
    orders = table(spark, sf_dir, "orders")
    r = orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")).first()   # two values
    step = (r["hi"] - r["lo"]) / len(kinds)
    for i, kind in enumerate(kinds):
        part = orders if i + 1 == len(kinds) else orders.where(F.col("o_orderdate") < F.lit(r["lo"] + step * (i + 1)))
        if i:
            part = part.where(F.col("o_orderdate") >= F.lit(r["lo"] + step * i))
        merge_batch(spark, part.withColumn("o_custkey", F.col("o_custkey").cast(kind)), flow, root, i)
    return read_target(spark, root)


def scd1_key_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key column is an int first, then a bigint: one row per key all the same."""
    return _drifting_keys(spark, sf_dir, "scd1_key_widened", _orders_flow(1), ["int", "bigint"])


def scd2_key_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above with versions; a later batch has ints again."""
    return _drifting_keys(spark, sf_dir, "scd2_key_widened", _orders_flow(2), ["int", "bigint", "int"])


def scd2_key_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key column becomes text: numbers keep their rows under the same digits."""
    return _drifting_keys(spark, sf_dir, "scd2_key_to_text", _orders_flow(2), ["bigint", "string", "int"])


def _named(name: str) -> str:
    return f"tidemark_{name}_{uuid.uuid4().hex[:8]}"


def gold_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of a declared target by SQL over its catalog name."""
    lay = Layout(scratch(spark, "gold_by_name"))
    reg, name = Registry(), _named("orders")
    orders = table(spark, sf_dir, "orders")

    @reg.table
    def orders_stg(s: SparkSession) -> DataFrame:
        return orders

    reg.create_streaming_table(name, buckets=16)
    reg.create_auto_cdc_flow(target=name, source="orders_stg", keys=["o_custkey"], sequence_by="o_orderdate",
                             stored_as_scd_type=2)
    reg.run(spark, lay, namespace=Namespace(schema="default"))
    return spark.sql(f"SELECT * FROM default.{name} WHERE __END_AT IS NOT NULL")


def gold_by_name_after_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target named after its first merge and read by that name after three
    further ones, the second of which brings a column."""
    root, name = scratch(spark, "gold_by_name_after_merges"), _named("events")
    ev, flow = table(spark, sf_dir, "events"), _flow(2)
    for i in range(4):
        part = ev.where(F.col("event_id") % 4 == i)
        merge_batch(spark, part if i > 1 else part.drop("props"), flow, root, i)
        if i == 0:
            register_target(spark, root, name)
    return spark.sql(f"SELECT * FROM {name}")


def silver_by_name_added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A silver table read by its catalog name after a file with a new column."""
    lay = Layout(scratch(spark, "silver_by_name_added_column"))
    ev = table(spark, sf_dir, "events")
    spec = SilverSpec(table="events", transform=drop_rescued, catalog_name=_named("silver"))
    for i, part in enumerate((ev.where("event_id % 2 = 0").drop("props"), ev.where("event_id % 2 = 1"))):
        append_bronze(part, lay.bronze("events"))
        run_silver(spark, spec, lay)
    return spark.table(spec.catalog_name)


def stream_type_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three bronze files: the customer key as int, as text (every tenth no number),
    as bigint. All rows stay; texts that are no number are rescued."""
    lay = Layout(scratch(spark, "stream_type_drift"))
    orders = table(spark, sf_dir, "orders")
    key, part = F.col("o_custkey"), F.col("o_orderkey") % 3
    text = F.when(key % 10 == 0, F.concat(F.lit("C-"), key)).otherwise(key.cast("string"))
    spec = SilverSpec(table="orders", rescue=True)
    for i, c in enumerate((key.cast("int"), text, key.cast("bigint"))):
        append_bronze(orders.where(part == i).withColumn("o_custkey", c), lay.bronze("orders"))
        if i != 1:   # text and bigint files in one run
            run_silver(spark, spec, lay)
    return read_silver(spark, spec, lay)


def table_stream_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver table streamed by its catalog name into an SCD1 target."""
    lay = Layout(scratch(spark, "table_stream_by_name"))
    ingest_table(spark, EVENTS, parquet_reader(spark, _paths(sf_dir)), lay)
    spec = SilverSpec(table="events", transform=drop_rescued, catalog_name=_named("silver"))
    run_silver(spark, spec, lay)
    flow = _flow(1)
    run_flow(spark, table_stream(spark, spec, lay), flow, lay.gold(flow.target), lay.gold_checkpoint(flow.flow_name))
    return read_target(spark, lay.gold(flow.target))


def declared_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared table built from a declared table, declared in any order."""
    lay = Layout(scratch(spark, "declared_chain"))
    ingest_table(spark, EVENTS, parquet_reader(spark, _paths(sf_dir)), lay)
    reg, schema = Registry(), table(spark, sf_dir, "events").schema

    @reg.table(reads=["events_stg"])
    def purchases(s: SparkSession) -> DataFrame:
        return reg.read_stream(s, "events_stg").where("event_type = 'purchase'")

    @reg.table
    @reg.expect_all_or_drop(EVENT_RULES)
    def events_stg(s: SparkSession) -> DataFrame:
        return s.readStream.schema(schema).parquet(lay.bronze("events"))

    reg.create_streaming_table("last_purchase", buckets=16)
    reg.create_auto_cdc_flow(target="last_purchase", source="purchases", keys=["user_id"], sequence_by="ts")
    return reg.run(spark, lay)["last_purchase"]


def declared_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of two runs of a declared batch table and of the target it feeds."""
    lay = Layout(scratch(spark, "declared_batch_metrics"))
    ev = table(spark, sf_dir, "events")
    for part in (ev.where("event_id % 2 = 0"), ev):
        reg = Registry()

        @reg.table
        @reg.expect_all_or_drop(EVENT_RULES)
        def events_stg(s: SparkSession, part: DataFrame = part) -> DataFrame:
            return part

        reg.create_streaming_table("purchases", expect_all_or_drop=TARGET_RULES, buckets=4)
        reg.create_auto_cdc_flow(target="purchases", source="events_stg", keys=["user_id"], sequence_by="ts")
        reg.run(spark, lay)
    rule = F.explode("failed").alias("rule", "failed_rows")
    return reg.dataset_metrics(spark, lay).select("dataset", "batch", "rows_in", "rows_out", rule)


def declared_chain_over_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch table feeds a batch table and a stream table, declared in any order and
    run twice; the stream table feeds a target."""
    lay = Layout(scratch(spark, "declared_chain_over_batch"))
    ev = table(spark, sf_dir, "events")
    for part in (ev.where("event_id % 2 = 0"), ev):
        reg = Registry()

        @reg.table
        def purchases(s: SparkSession, reg: Registry = reg) -> DataFrame:
            return reg.read_stream(s, "events_stg").join(reg.read(s, "buyers"), "user_id", "left_semi")

        @reg.table
        def buyers(s: SparkSession, reg: Registry = reg) -> DataFrame:
            return reg.read(s, "events_stg").where("event_type = 'purchase'").select("user_id").distinct()

        @reg.table
        @reg.expect_all_or_drop(EVENT_RULES)
        def events_stg(s: SparkSession, part: DataFrame = part) -> DataFrame:
            return part

        reg.create_streaming_table("buyers_last", buckets=4)
        reg.create_auto_cdc_flow(target="buyers_last", source="purchases", keys=["user_id"], sequence_by="ts")
        out = reg.run(spark, lay, namespace=Namespace(schema="default"))
    for name in ("purchases", "buyers", "events_stg"):
        spark.sql(f"DROP TABLE default.{name}")
    return out["buyers_last"]


def one_shot_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named one-shot flow is applied once per checkpoint: what its source holds when
    it runs again is left alone."""
    root = scratch(spark, "one_shot_flow")
    orders = table(spark, sf_dir, "orders")
    flow = CdcFlow(target="orders_gold", source="orders", keys=["o_custkey"], sequence_by="o_orderdate", name="backfill",
                   once=True, buckets=8)
    run_flow(spark, orders.where("o_orderkey % 2 = 0"), flow, root, f"{root}/_cp/{flow.flow_name}")
    run_flow(spark, orders, flow, root, f"{root}/_cp/{flow.flow_name}")
    return read_target(spark, root)


def watermark_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All marks of a table's runs, read recursively from the folder of its documents."""
    lay = Layout(scratch(spark, "watermark_log"))
    orders = table(spark, sf_dir, "orders")
    for cap in MARK_CAPS:
        state = orders.where(F.col("o_orderdate") <= F.to_timestamp_ntz(F.lit(cap)))
        ingest_table(spark, ORDERS, frame_reader({"orders": state}), lay)
    return watermark_history(spark, lay.watermark("orders")).select("cdc")


def silver_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named silver table, its data and its checkpoint are dropped; the next run
    creates it again from all of bronze."""
    lay = Layout(scratch(spark, "silver_reset"))
    ingest_table(spark, EVENTS, parquet_reader(spark, _paths(sf_dir)), lay)
    spec = SilverSpec(table="events", transform=drop_rescued, catalog_name=_named("reset"))
    run_silver(spark, spec, lay)
    reset_silver(spark, spec, lay)
    assert not spark.catalog.tableExists(spec.catalog_name)
    run_silver(spark, spec, lay)
    return spark.table(spec.catalog_name)


def _ruled_target(spark: SparkSession, sf_dir: str, name: str) -> Layout:
    lay = Layout(scratch(spark, name))
    reg, ev = Registry(), table(spark, sf_dir, "events")

    @reg.table
    @reg.expect_all_or_drop(EVENT_RULES)
    def events_stg(s: SparkSession) -> DataFrame:
        return ev

    reg.create_streaming_table("purchases", expect_all_or_drop=TARGET_RULES, buckets=16)
    reg.create_auto_cdc_flow(target="purchases", source="events_stg", keys=["user_id"], sequence_by="ts",
                             stored_as_scd_type=2)
    reg.run(spark, lay)
    return lay


def target_expectation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target's own rule drops rows that the staging rules keep."""
    return read_target(spark, _ruled_target(spark, sf_dir, "target_expectation").gold("purchases"))


def upserted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows upserted and dropped per target."""
    lay = _ruled_target(spark, sf_dir, "upserted_rows")
    return upsert_report(spark, {"purchases": lay.gold("purchases")})


def failed_table_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that can't be read is recorded; the others are ingested."""
    lay = Layout(scratch(spark, "failed_table_report"))
    paths = _paths(sf_dir) | {"events": f"{sf_dir}/no_such_table.parquet"}
    rep = ingest_all(spark, [ORDERS, EVENTS, LINEITEM], parquet_reader(spark, paths), lay, raise_on_failure=False,
                     pipeline="daily")
    return rep.select("pipeline", "table_name", "status", "rows_read")


def converted_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type conversion on the way to bronze: prices cut to whole numbers, keys to text,
    priorities to their first characters."""
    lay = Layout(scratch(spark, "converted_copy"))
    schema = T.StructType([T.StructField("o_orderkey", T.StringType()), T.StructField("o_custkey", T.DoubleType()),
                           T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.IntegerType()),
                           T.StructField("o_orderdate", T.TimestampNTZType()),
                           T.StructField("o_orderpriority", T.VarcharType(3))])
    ingest_table(spark, ORDERS, parquet_reader(spark, _paths(sf_dir)), lay, target_schema=schema)
    return spark.read.parquet(lay.bronze("orders"))


def converted_copy_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that do not convert on the way to bronze: counted in the run report, and
    kept with their rows."""
    lay = Layout(scratch(spark, "converted_copy_rejects"))
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(F.col("o_custkey") % 11 == 0, F.concat(F.lit("C-"), "o_custkey")).otherwise(F.col("o_custkey").cast("string")))
    schema = T.StructType([T.StructField("o_orderkey", T.ShortType()), T.StructField("o_custkey", T.LongType()),
                           T.StructField("o_totalprice", T.IntegerType()), T.StructField("o_orderdate", T.DateType())])
    rep = ingest_all(spark, [ORDERS], frame_reader({"orders": orders}), lay, schemas={"orders": schema})
    per_column = rep.select(F.explode_outer("rejected").alias("column_name", "reported"))
    return (read_rejects(spark, "orders", lay).groupBy("column_name", "wanted")
            .agg(F.count("*").alias("n"), F.countDistinct("value").alias("n_values"), F.min("value").alias("least"),
                 F.max("value").alias("greatest"))
            .join(per_column, "column_name", "full"))


def constant_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").transform(with_constants({"cdc": "2025-01-01"}))


def range_flag_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Banding with NULLs: every seventh size is missing."""
    size = F.when(F.col("p_partkey") % 7 > 0, F.col("p_size"))
    p = table(spark, sf_dir, "part").select("p_partkey", size.alias("p_size"))
    return p.withColumn("size_flag", band("p_size", SIZE_BANDS, SIZE_DEFAULT))


def expect_or_drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over NULLs: every fifth user is missing, every third type."""
    ev = table(spark, sf_dir, "events")
    ev = (ev.withColumn("user_id", F.when(F.col("event_id") % 5 > 0, F.col("user_id")))
          .withColumn("event_type", F.when(F.col("event_id") % 3 > 0, F.col("event_type"))))
    return expect_all_or_drop(ev, EVENT_RULES)


# --- star joins -------------------------------------------------------------------

STAR = [
    JoinSpec("lineitem", "l", ["l.l_orderkey", "l.l_linenumber", "l.l_quantity", "l.l_extendedprice"]),
    JoinSpec("orders", "o", ["o.o_orderdate", "o.o_orderpriority"], "l.l_orderkey = o.o_orderkey"),
    JoinSpec("customer", "c", ["c.c_name", "c.c_mktsegment"], "o.o_custkey = c.c_custkey"),
]


def star_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_join(STAR, lambda t: table(spark, sf_dir, t))


def star_dup_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze orders after a full load and a backfill hold two copies of the
    re-extracted orders; joining to them multiplies the fact rows."""
    lay = Layout(scratch(spark, "star_dup_dimension"))
    reader = parquet_reader(spark, _paths(sf_dir))
    ingest_table(spark, ORDERS, reader, lay)
    ingest_table(spark, ORDERS, reader, lay, from_date=ORDERS_FIRST_RUN_CAP)
    tables = {"lineitem": table(spark, sf_dir, "lineitem"),
              "bronze_orders": spark.read.parquet(lay.bronze("orders"))}
    specs = [JoinSpec("lineitem", "l", ["l.l_orderkey", "l.l_linenumber"]),
             JoinSpec("bronze_orders", "o", ["o.o_orderdate", "o.o_totalprice"],
                      "l.l_orderkey = o.o_orderkey")]
    return star_join(specs, tables.__getitem__)


def star_bounded_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small table joined by a range, then a plain equality: the range's side is
    counted before it is sent to every task."""
    specs = [JoinSpec("orders", "o", ["o.o_orderkey", "o.o_totalprice"]),
             JoinSpec("bands", "b", ["b.least"], "o.o_totalprice >= b.least AND o.o_totalprice < b.below", bounded=True, max_rows=1000),
             JoinSpec("customer", "c", ["c.c_name"], "o.o_custkey = c.c_custkey")]
    bands = (table(spark, sf_dir, "nation")
             .select((F.col("n_nationkey") * 20_000.0).alias("least"), ((F.col("n_nationkey") + 1) * 20_000.0).alias("below")))
    return star_join(specs, lambda t: bands if t == "bands" else table(spark, sf_dir, t))


# --- the whole chain ----------------------------------------------------------------

def orders_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ingest runs of orders -> silver (clean priority text) -> SCD1
    gold keyed by order -> star join with customer."""
    lay = Layout(scratch(spark, "orders_chain"))
    orders = table(spark, sf_dir, "orders")
    early = orders.where(F.col("o_orderdate") <= F.to_timestamp_ntz(F.lit(ORDERS_FIRST_RUN_CAP)))
    spec = SilverSpec(table="orders",
                      transform=lambda df: drop_rescued(df).withColumn(
                          "o_orderpriority", replace_all("o_orderpriority", "-", " ")))
    # order keys only grow: range buckets, so later runs touch recent buckets
    flow = CdcFlow(target="orders_gold", source="orders", keys=["o_orderkey"],
                   sequence_by="o_orderdate", stored_as_scd_type=1, bucket_width=ORDER_BUCKET_WIDTH)
    for state in (early, orders):
        ingest_table(spark, ORDERS, frame_reader({"orders": state}), lay)
        run_silver(spark, spec, lay)
        run_flow(spark, table_stream(spark, spec, lay), flow, lay.gold(flow.target),
                 lay.gold_checkpoint(flow.flow_name))
    tables = {"orders": read_target(spark, lay.gold(flow.target)),
              "customer": table(spark, sf_dir, "customer")}
    specs = [JoinSpec("orders", "o", ["o.o_orderkey", "o.o_orderdate", "o.o_orderpriority", "o.o_totalprice"]),
             JoinSpec("customer", "c", ["c.c_name", "c.c_mktsegment"], "o.o_custkey = c.c_custkey")]
    return star_join(specs, tables.__getitem__)


QUERIES: dict[str, Query] = {
    "incremental_extract": incremental_extract,
    "backfill_extract": backfill_extract,
    "extract_two_runs": extract_two_runs,
    "watermark_max": watermark_max,
    "ingest_report": ingest_report,
    "drop_columns": drop_columns_q,
    "upper_name": upper_name,
    "regexp_clean": regexp_clean,
    "range_flag": range_flag,
    "stream_copy": stream_copy,
    "stream_first_arrival": stream_first_arrival,
    "stream_first_arrival_merge": stream_first_arrival_merge,
    "expect_or_drop": expect_or_drop,
    "expect_metrics": expect_metrics,
    "scd1_latest": scd1_latest_q,
    "scd1_out_of_order": scd1_out_of_order,
    "scd1_batch": scd1_batch,
    "scd2_history": scd2_history,
    "scd2_out_of_order": scd2_out_of_order,
    "scd2_batch": scd2_batch,
    "scd2_except_columns": scd2_except_columns,
    "scd2_closed": scd2_closed,
    "scd2_lineage": scd2_lineage,
    "scd1_daily_merge": scd1_daily_merge,
    "scd2_daily_merge": scd2_daily_merge,
    "scd2_except_daily_merge": scd2_except_daily_merge,
    "scd1_orders_daily_merge": scd1_orders_daily_merge,
    "scd2_orders_daily_merge": scd2_orders_daily_merge,
    "declared_flows": declared_flows,
    "key_uniqueness": key_uniqueness,
    "star_left_join": star_left_join,
    "star_dup_dimension": star_dup_dimension,
    "orders_chain": orders_chain,
    "scd2_added_column": scd2_added_column,
    "scd1_key_widened": scd1_key_widened,
    "scd2_key_widened": scd2_key_widened,
    "scd2_key_to_text": scd2_key_to_text,
    "gold_by_name": gold_by_name,
    "gold_by_name_after_merges": gold_by_name_after_merges,
    "silver_by_name_added_column": silver_by_name_added_column,
    "stream_type_drift": stream_type_drift,
    "table_stream_by_name": table_stream_by_name,
    "declared_chain": declared_chain,
    "target_expectation": target_expectation,
    "upserted_rows": upserted_rows,
    "failed_table_report": failed_table_report,
    "converted_copy": converted_copy,
    "converted_copy_rejects": converted_copy_rejects,
    "late_rows_lookback": late_rows_lookback,
    "declared_batch_metrics": declared_batch_metrics,
    "declared_chain_over_batch": declared_chain_over_batch,
    "star_bounded_theta": star_bounded_theta,
    "watermark_log": watermark_log,
    "silver_reset": silver_reset,
    "one_shot_flow": one_shot_flow,
    "constant_column": constant_column,
    "range_flag_nulls": range_flag_nulls,
    "expect_or_drop_nulls": expect_or_drop_nulls,
}

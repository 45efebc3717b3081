"""Plan-level checks: hot keys are spread, no Python in the hot path,
filters and column pruning reach the scan."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.cdc import _keyed, _prepare, scd1_latest, scd2_versions
from tidemark.plans import queries as Q

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_burst_of_one_key_is_spread_over_tasks(spark):
    """One million rows of one key inside one hour, a few of others: no partition of
    the (key, chunk) shuffle holds more than a small share of them."""
    start = F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz")
    n = 1_000_000
    seq = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.pmod(F.col("id") * 7919, F.lit(n)) / 300).cast("decimal(18,6)"))
    hot = spark.range(n).select(F.lit(1).alias("k"), seq.alias("seq"), (F.col("id") % 3).alias("v"))
    cold = spark.range(50).select((F.col("id") + 2).cast("int").alias("k"), start.alias("seq"), F.col("id").alias("v"))
    df = hot.unionByName(cold)
    keyed, split = _keyed(df, ["k"], "seq")
    assert split
    chunks = keyed.groupBy("k", "__chunk").count().collect()
    assert {r["__chunk"] for r in chunks if r["k"] != 1} == {-1}
    sizes = [r["count"] for r in chunks if r["k"] == 1]
    assert sum(sizes) == n and len(sizes) > 900 and max(sizes) < n / 200
    # tiny rows: keep AQE from merging the shuffle partitions back into one
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = [r["n"] for r in _prepare(keyed).groupBy(F.spark_partition_id().alias("p"))
                    .agg(F.count(F.lit(1)).alias("n")).collect()]
        v = scd2_versions(df, ["k"], "seq")
        open_, gaps = v.where("__END_AT IS NULL").count(), v.where("__END_AT <= __START_AT").count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(per_task) < 0.25 * n      # 8 partitions
    assert (open_, gaps) == (51, 0) and v.count() == df.select("k", "seq").distinct().count()


def test_scd1_combines_map_side(spark):
    df = spark.read.parquet(f"{SF}/events.parquet")
    plan = _plan(scd1_latest(df, ["user_id"], "ts"))
    assert "partial_max" in plan


def test_no_python_in_registered_query_plans(spark):
    """Every batch query that returns a plain DataFrame runs JVM-side only."""
    for name in ("drop_columns", "upper_name", "regexp_clean", "range_flag", "expect_or_drop",
                 "expect_metrics", "scd1_batch", "scd2_batch", "key_uniqueness", "star_left_join",
                 "watermark_max"):
        plan = _plan(Q.QUERIES[name](spark, SF))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in plan, (name, node)


def test_projection_and_filters_reach_the_scan(spark):
    plan = _plan(Q.star_left_join(spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double>" in plan
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    from tidemark.sources.extract import incremental_extract
    plan = _plan(incremental_extract(orders, "o_orderdate", "1998-01-01", "1999-01-01"))
    assert "GreaterThan(o_orderdate" in plan and "LessThanOrEqual(o_orderdate" in plan


def test_untouched_keys_are_copied_without_a_shuffle(spark, root):
    """Gold merge of a small batch: stored rows of keys the batch does not
    touch leave through a broadcast anti join (map-only), and the touched
    keys through a broadcast semi join; neither reads the stored rows
    through a shuffle."""
    from pyspark import StorageLevel
    from tidemark.functions.columns import key_struct
    from tidemark.streaming import live as L
    from tidemark.streaming.gold import KEY, CdcFlow, _split_by_keys, merge_batch
    ev = spark.read.parquet(f"{SF}/events.parquet")
    flow = CdcFlow(target="e", source="s", keys=["user_id"], sequence_by="ts", stored_as_scd_type=2, buckets=4)
    merge_batch(spark, ev, flow, root, 0)
    batch = ev.where(F.col("user_id") < 3)
    keys = batch.select(key_struct(["user_id"]).alias(KEY)).distinct().persist(StorageLevel.MEMORY_AND_DISK)
    try:
        hit, kept = _split_by_keys(L.rows(spark, root, L.latest(spark, root), "data"), F.broadcast(keys), ["user_id"])
        for df, kind in ((kept, "LeftAnti"), (hit, "LeftSemi")):
            plan = _plan(df)
            assert f"BroadcastHashJoin [{KEY}" in plan and kind in plan, plan
            # the only shuffle is inside the cached, batch-sized key set
            stored_side = plan.split("InMemoryRelation")[0]
            assert "Exchange hashpartitioning" not in stored_side, plan
        m = merge_batch(spark, batch.withColumn("value", F.col("value") + 1), flow, root, 1)
        assert m["split_by_keys"]
    finally:
        keys.unpersist()


def test_seen_key_history_is_filtered_map_side(spark, layout):
    """Merge-mode dedup: of the history the second batch reads the buckets its keys
    fall in, filtered by a broadcast of fixed size without a shuffle of the
    history before it."""
    from pyspark import StorageLevel
    from tidemark.functions.columns import bucket_of, canonical_key
    from tidemark.streaming import silver as S
    spec = S.SilverSpec(table="e", dedup_keys=["event_id"], dedup_buckets=32)
    ev = spark.read.parquet(f"{SF}/events.parquet")
    S.first_arrivals(spark, ev.withColumn(S.ARRIVAL, F.col("ts")), 0, spec, layout)
    seen_dir = S._seen_dir(spec, layout)
    folders = S._seen_state(spark, seen_dir)["folders"]
    batch = (ev.where("event_id < 3").withColumn(S.BUCKET, bucket_of(ev.schema, ["event_id"], 32))
             .withColumn(S.KEY, canonical_key(ev.schema, ["event_id"])).withColumn(S.HASH, F.xxhash64(S.KEY))
             .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        touched = [r[0] for r in batch.select(S.BUCKET).distinct().collect()]
        assert 0 < len(touched) <= 3
        history = S._seen(spark, seen_dir, folders, batch.select(S.KEY, S.HASH).schema)
        out = S.unseen(batch, history, touched)
        plan = _plan(out)
        assert "__slot" in plan and "BroadcastHashJoin [__slot" in plan and "LeftSemi" in plan, plan
        scan = next(ln for ln in plan.splitlines() if "FileScan parquet" in ln and "__hash" in ln)
        assert "PartitionFilters: [__bucket" in scan or "PartitionFilters: [isnotnull(__bucket" in scan, scan
        # the history is shuffled, if at all, behind the filter (plans list children below)
        lines = plan.splitlines()
        at = lines.index(scan)
        semi = max(i for i, ln in enumerate(lines[:at]) if "LeftSemi" in ln)
        assert not any("Exchange hashpartitioning" in ln for ln in lines[semi:at]), plan
        assert out.count() == 0
        # the share of the history that is read: its touched buckets
        assert history.where(F.col(S.BUCKET).isin(touched)).count() < 0.25 * history.count()
    finally:
        batch.unpersist()


def test_scd2_shuffles_rows_once(spark):
    """SCD2 with and without an exclusion list: one exchange of the rows on
    (key, chunk)."""
    ev = spark.read.parquet(f"{SF}/events.parquet")
    for except_cols in (None, ["ts", "value", "event_id", "props"]):
        plan = _plan(scd2_versions(ev, ["user_id"], "ts", except_cols))
        wide = [ln for ln in plan.splitlines() if "Exchange" in ln and "REPARTITION_BY_COL" in ln]
        assert 1 <= len(set(ln.split("[plan_id")[0].lstrip(" :+-*()0123456789") for ln in wide)) <= 2, plan
        # without a hot key, which a count decides, nothing else is shuffled
        assert plan.count("Exchange") == len(wide), plan

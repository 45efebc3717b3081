import datetime as dt

from pyspark.sql import functions as F

from tidemark.config import Namespace
from tidemark.operators.transforms import with_constants
from tidemark.sinks.bronze import append_bronze
from tidemark.sinks.tables import create_table, drop_table, preview, reset_table, use_namespace
from tidemark.streaming.gold import CdcFlow, read_target, reset_target, run_flow, upsert_report
from tidemark.streaming.silver import SilverSpec, run_silver, table_stream
from tidemark import fs

SCHEMA = "k int, seq timestamp_ntz, v string"


def test_catalog_tables_namespace_and_preview(spark, layout):
    use_namespace(spark, Namespace(schema="tm_dev"))
    spec = SilverSpec(table="t", catalog_name="tm_dev.silver_t")
    append_bronze(spark.createDataFrame([(1, dt.datetime(2025, 1, 1), "a")], SCHEMA), layout.bronze("t"))
    run_silver(spark, spec, layout)
    assert spark.table("tm_dev.silver_t").count() == 1
    assert table_stream(spark, spec, layout).isStreaming
    assert preview(spark.table("tm_dev.silver_t"), 5).count() == 1
    drop_table(spark, "tm_dev.silver_t")
    assert not spark.catalog.tableExists("tm_dev.silver_t")
    # a deduplicated (merge-mode) silver table is registered too
    dspec = SilverSpec(table="d", catalog_name="tm_dev.silver_d", dedup_keys=["k"])
    append_bronze(spark.createDataFrame([(1, dt.datetime(2025, 1, 1), "a"), (1, dt.datetime(2025, 1, 2), "b")],
                                        SCHEMA).coalesce(1), layout.bronze("d"))
    run_silver(spark, dspec, layout)
    append_bronze(spark.createDataFrame([(2, dt.datetime(2025, 1, 3), "c")], SCHEMA), layout.bronze("d"))
    run_silver(spark, dspec, layout)
    assert sorted(r.k for r in spark.table("tm_dev.silver_d").collect()) == [1, 2]
    assert table_stream(spark, dspec, layout).isStreaming
    drop_table(spark, "tm_dev.silver_d")
    t = create_table(spark, "tm_dev.empty_t", f"{layout.root}/empty", spark.createDataFrame([], SCHEMA).schema)
    assert t.count() == 0
    reset_table(spark, "tm_dev.empty_t", [f"{layout.root}/empty"], layout.root)
    assert not fs.exists(spark, f"{layout.root}/empty")
    spark.catalog.setCurrentDatabase("default")


def test_constant_columns(spark):
    df = spark.createDataFrame([(1,)], "a int").transform(with_constants({"cdc": "2025-01-01"}))
    assert df.first().cdc == "2025-01-01"


def test_once_flow_runs_once_and_upsert_report(spark, root):
    rows = [(1, dt.datetime(2025, 1, 1), "a"), (2, dt.datetime(2025, 1, 1), "b"), (None, None, "x")]
    src = spark.createDataFrame(rows, SCHEMA)
    flow = CdcFlow(target="t", source="s", keys=["k"], sequence_by="seq", stored_as_scd_type=1,
                   once=True, expectations={"has_key": "k IS NOT NULL"}, buckets=4)
    run_flow(spark, src, flow, f"{root}/t", f"{root}/cp")
    run_flow(spark, src.union(src), flow, f"{root}/t", f"{root}/cp")   # ignored: already done
    assert read_target(spark, f"{root}/t").count() == 2
    rep = upsert_report(spark, {"t": f"{root}/t"}).first()
    assert (rep.batches, rep.rows_upserted, rep.rows_dropped) == (1, 2, 1)
    reset_target(spark, f"{root}/t", f"{root}/cp", root)
    assert not fs.exists(spark, f"{root}/t")

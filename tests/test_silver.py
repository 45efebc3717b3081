import datetime as dt

import pytest

from tidemark.config import SourceTable
from tidemark.plans.ingest import ingest_table
from tidemark.sinks.bronze import append_bronze
from tidemark.sources.relational import frame_reader
from tidemark.streaming.silver import SilverSpec, read_silver, reset_silver, run_silver
from tidemark.operators.transforms import clean_users
from tidemark import fs

SCHEMA = "user_id int, user_name string, updated_at timestamp_ntz"


def t(d):
    return dt.datetime(2025, 1, d)


@pytest.mark.parametrize("mode", ["merge", "state"])
def test_restart_reads_only_new_files_and_dedup_holds(spark, layout, mode):
    spec = SilverSpec(table="users", transform=clean_users, dedup_keys=["user_id"], dedup_mode=mode)
    append_bronze(spark.createDataFrame([(1, "a", t(1)), (2, "b", t(1))], SCHEMA), layout.bronze("users"))
    assert run_silver(spark, spec, layout).count() == 2
    # second run without new files: nothing new
    assert run_silver(spark, spec, layout).count() == 2
    # a later file with an update of user 1 and a new user 3: first arrival wins for ever
    append_bronze(spark.createDataFrame([(1, "changed", t(2)), (3, "c", t(2))], SCHEMA), layout.bronze("users"))
    out = {r.user_id: r.user_name for r in run_silver(spark, spec, layout).collect()}
    assert out == {1: "A", 2: "B", 3: "C"}


@pytest.mark.parametrize("mode", ["merge", "state"])
def test_added_column_survives_restart(spark, layout, mode):
    spec = SilverSpec(table="t", dedup_keys=["user_id"], dedup_mode=mode)
    append_bronze(spark.createDataFrame([(1, "a", t(1))], SCHEMA), layout.bronze("t"))
    run_silver(spark, spec, layout)
    newer = spark.createDataFrame([(2, "b", t(2), "DE")], SCHEMA + ", country string")
    append_bronze(newer, layout.bronze("t"))
    out = {r.user_id: r.country for r in run_silver(spark, spec, layout).collect()}
    assert out == {1: None, 2: "DE"}


def test_reset_reloads_everything(spark, layout):
    spec = SilverSpec(table="t")
    append_bronze(spark.createDataFrame([(1, "a", t(1))], SCHEMA), layout.bronze("t"))
    run_silver(spark, spec, layout)
    reset_silver(spark, spec, layout)
    assert not fs.exists(spark, layout.silver_checkpoint("t"))
    assert run_silver(spark, spec, layout).count() == 1


def test_rate_limited_run_drains_everything(spark, layout):
    cfg = SourceTable(table="t", cdc_col="updated_at")
    for d in (1, 2, 3):
        src = spark.createDataFrame([(i, "x", t(i)) for i in range(1, d + 1)], SCHEMA)
        ingest_table(spark, cfg, frame_reader({"t": src}), layout)
    spec = SilverSpec(table="t", max_files_per_trigger=1)
    assert sorted(r.user_id for r in run_silver(spark, spec, layout).collect()) == [1, 2, 3]
    assert read_silver(spark, spec, layout).count() == 3
    # the same bronze files through a size limit (one small file per batch)
    by_size = SilverSpec(table="t", dedup_keys=["user_id"], max_bytes_per_trigger=1024)
    from tidemark.paths import Layout
    other = Layout(layout.root + "_bytes")
    spark.read.parquet(layout.bronze("t")).repartition(3).write.parquet(other.bronze("t"))
    assert sorted(r.user_id for r in run_silver(spark, by_size, other).collect()) == [1, 2, 3]


def test_merge_mode_first_arrival_is_deterministic_and_kept_for_ever(spark, layout):
    """Merge-mode dedup: within one run the earliest file wins (not an
    arbitrary row), later runs never replace a key, and a hot key with many
    rows in one batch is reduced to one row."""
    spec = SilverSpec(table="u", dedup_keys=["user_id"], dedup_mode="merge", dedup_buckets=4)
    first = [(1, "first", t(1)), (2, "b", t(1))] + [(7, f"hot{i}", t(1)) for i in range(50)]
    append_bronze(spark.createDataFrame(first, SCHEMA).coalesce(1), layout.bronze("u"))
    append_bronze(spark.createDataFrame([(1, "second", t(2)), (3, "c", t(2))], SCHEMA), layout.bronze("u"))
    out = {r.user_id: r.user_name for r in run_silver(spark, spec, layout).collect()}
    assert out == {1: "first", 2: "b", 3: "c", 7: "hot0"}
    append_bronze(spark.createDataFrame([(2, "later", t(3)), (4, "d", t(3)), (None, "n", t(3))], SCHEMA),
                  layout.bronze("u"))
    out = {r.user_id: r.user_name for r in run_silver(spark, spec, layout).collect()}
    assert out == {1: "first", 2: "b", 3: "c", 4: "d", 7: "hot0", None: "n"}
    # restart without new files: nothing changes
    assert run_silver(spark, spec, layout).count() == 6


def test_schema_check_reads_only_new_files(spark, layout):
    """After the first run only footers of files newer than the previous
    check are read: an old bronze file that became unreadable (and is
    already processed) does not matter, a new column is still picked up,
    and a run with no new file reuses the remembered schema."""
    import glob
    import os
    spec = SilverSpec(table="s")
    append_bronze(spark.createDataFrame([(1, "a", t(1))], SCHEMA), layout.bronze("s"))
    run_silver(spark, spec, layout)
    old = [f for f in glob.glob(layout.bronze("s").replace("file:", "") + "/*.parquet")]
    assert old
    for f in old:
        with open(f, "wb") as fh:
            fh.write(b"not parquet")
        os.utime(f, (0, 0))
    assert run_silver(spark, spec, layout).count() == 1          # nothing new: remembered schema
    append_bronze(spark.createDataFrame([(2, "b", t(2), "DE")], SCHEMA + ", country string"),
                  layout.bronze("s"))
    out = {r.user_id: r.country for r in run_silver(spark, spec, layout).collect()}
    assert out == {1: None, 2: "DE"}


def test_old_dated_file_is_read_and_its_new_column_kept(spark, layout):
    """A file that carries an old modification time (restored, copied late) is
    processed like any other, and so is a column only it has."""
    import glob
    import os
    spec = SilverSpec(table="o")
    for i in (0, 1):
        append_bronze(spark.createDataFrame([(i, "a", t(1))], SCHEMA), layout.bronze("o"))
        run_silver(spark, spec, layout)
    before = set(glob.glob(layout.bronze("o") + "/*.parquet"))
    append_bronze(spark.createDataFrame([(2, "b", t(2), "DE")], SCHEMA + ", country string"), layout.bronze("o"))
    for f in set(glob.glob(layout.bronze("o") + "/*.parquet")) - before:
        os.utime(f, (1, 1))
    append_bronze(spark.createDataFrame([(3, "c", t(3))], SCHEMA), layout.bronze("o"))
    out = {r.user_id: r.country for r in run_silver(spark, spec, layout).collect()}
    assert out == {0: None, 1: None, 2: "DE", 3: None}


def test_dedup_cannot_change_under_a_table(spark, layout):
    append_bronze(spark.createDataFrame([(1, "a", t(1))], SCHEMA), layout.bronze("x"))
    run_silver(spark, SilverSpec(table="x"), layout)
    with pytest.raises(ValueError, match="reset_silver"):
        run_silver(spark, SilverSpec(table="x", dedup_keys=["user_id"]), layout)


def test_replayed_merge_batch_writes_the_same_rows(spark, layout):
    from tidemark.streaming.silver import ARRIVAL, first_arrivals
    from pyspark.sql import functions as F
    spec = SilverSpec(table="r", dedup_keys=["user_id"], dedup_buckets=4)
    def batch(rows):
        return spark.createDataFrame(rows, SCHEMA).withColumn(ARRIVAL, F.struct(F.col("updated_at").alias("t")))
    first_arrivals(spark, batch([(1, "a", t(1)), (2, "b", t(1))]), 0, spec, layout)
    for _ in range(2):
        first_arrivals(spark, batch([(2, "x", t(2)), (3, "c", t(2))]), 1, spec, layout)
    out = read_silver(spark, spec, layout, schema=spark.createDataFrame([], SCHEMA).schema).collect()
    assert {r.user_id: r.user_name for r in out} == {1: "a", 2: "b", 3: "c"} and len(out) == 3


@pytest.mark.parametrize("mode", ["merge", "state"])
def test_plain_readers_of_the_folder_see_every_row(spark, layout, mode):
    """A batch read and a stream of the table's folder, by any reader, in both
    forms of storage, after a replay too."""
    from pyspark.sql import functions as F
    from tidemark.streaming.silver import ARRIVAL, BATCH, first_arrivals
    spec = SilverSpec(table="p", dedup_keys=["user_id"], dedup_mode=mode, dedup_buckets=4)
    for d in (1, 2):
        append_bronze(spark.createDataFrame([(d, "a", t(d)), (9, "x", t(d))], SCHEMA), layout.bronze("p"))
        run_silver(spark, spec, layout)
    if mode == "merge":   # the second batch again
        again = spark.createDataFrame([(2, "a", t(2)), (9, "x", t(2))], SCHEMA)
        first_arrivals(spark, again.withColumn(ARRIVAL, F.struct(F.col("updated_at").alias("t"))), 1, spec, layout)
    folder = layout.silver_data("p")
    assert sorted(r.user_id for r in spark.read.parquet(folder).collect()) == [1, 2, 9]
    schema = read_silver(spark, spec, layout).schema
    assert schema.fieldNames() == ["user_id", "user_name", "updated_at"]
    assert spark.read.schema(schema).parquet(folder).drop(BATCH).count() == 3
    q = (spark.readStream.schema(schema).parquet(folder).writeStream.format("memory").queryName(f"plain_{mode}")
         .option("checkpointLocation", f"{layout.root}/cp_{mode}").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.user_id for r in spark.table(f"plain_{mode}").collect()) == [1, 2, 9]


@pytest.mark.parametrize("dedup", [None, ["user_id"]])
def test_a_name_shows_columns_added_later(spark, layout, dedup):
    from tidemark.streaming.silver import table_stream
    name = f"silver_added_{'merge' if dedup else 'plain'}"
    spec = SilverSpec(table="n", dedup_keys=dedup, catalog_name=name)
    append_bronze(spark.createDataFrame([(1, "a", t(1))], SCHEMA), layout.bronze("n"))
    run_silver(spark, spec, layout)
    append_bronze(spark.createDataFrame([(2, "b", t(2), "DE")], SCHEMA + ", country string"), layout.bronze("n"))
    run_silver(spark, spec, layout)
    want = {1: None, 2: "DE"}
    assert {r.user_id: r.country for r in spark.table(name).collect()} == want
    q = (table_stream(spark, spec, layout).writeStream.format("memory").queryName(f"s_{name}")
         .option("checkpointLocation", f"{layout.root}/cp").trigger(availableNow=True).start())
    q.awaitTermination()
    assert {r.user_id: r.country for r in spark.table(f"s_{name}").collect()} == want
    spark.sql(f"DROP TABLE {name}")


def test_key_history_is_compacted_and_still_holds(spark, layout, monkeypatch):
    from pyspark.sql import functions as F
    from tidemark.streaming import silver as S
    monkeypatch.setattr(S, "COMPACT_AFTER", 2)
    spec = SilverSpec(table="h", dedup_keys=["user_id"], dedup_buckets=2)
    for i in range(6):
        rows = [(k, f"b{i}", t(1 + i)) for k in (i, i - 1, 0, None)]
        S.first_arrivals(spark, spark.createDataFrame(rows, SCHEMA).withColumn(S.ARRIVAL, F.struct(F.col("updated_at"))), i, spec, layout)
    out = read_silver(spark, spec, layout, schema=spark.createDataFrame([], SCHEMA).schema).collect()
    assert sorted((str(r.user_id), r.user_name) for r in out) == sorted(
        [("-1", "b0"), ("None", "b0"), *((str(k), f"b{k}") for k in range(6))])
    state = S._seen_state(spark, S._seen_dir(spec, layout))
    assert len(state["folders"]) <= 3 and state["batch"] == 5
    assert sorted(n for n in fs.list_dirs(spark, S._seen_dir(spec, layout)) if n.startswith("keys-")) == sorted(state["folders"])


# --- values that do not fit ----------------------------------------------------

DRIFT = [[(1, "a", t(1))], [("2", "b", t(2)), ("x3", "c", t(3)), (None, "d", t(4))], [(5, "e", t(5))]]
DRIFT_KINDS = ["user_id int", "user_id string", "user_id bigint"]


def _drift(spark, layout, table, order=(0, 1, 2)):
    for i in order:
        append_bronze(spark.createDataFrame(DRIFT[i], f"{DRIFT_KINDS[i]}, user_name string, updated_at timestamp_ntz").coalesce(1),
                      layout.bronze(table))


@pytest.mark.parametrize("runs", [1, 3])
def test_a_changed_type_keeps_the_rows(spark, layout, runs):
    """int, text and bigint files, in one run or one after the other."""
    spec = SilverSpec(table="d", rescue=True)
    for i in range(3):
        _drift(spark, layout, "d", (i,))
        if runs == 3:
            run_silver(spark, spec, layout)
    out = run_silver(spark, spec, layout)
    assert out.schema["user_id"].dataType.simpleString() == "int"
    assert sorted((r.user_name, r.user_id, r._rescued_data) for r in out.collect()) == [
        ("a", 1, None), ("b", 2, None), ("c", None, '{"user_id":"x3"}'), ("d", None, None), ("e", 5, None)]
    assert run_silver(spark, spec, layout).count() == 5   # nothing new


def test_rescue_with_dedup_transform_name_and_new_column(spark, layout):
    from tidemark.operators.transforms import drop_rescued
    from tidemark.streaming.silver import table_stream
    spec = SilverSpec(table="e", rescue=True, transform=drop_rescued, dedup_keys=["user_name"], catalog_name="silver_rescue")
    _drift(spark, layout, "e")
    append_bronze(spark.createDataFrame([(1 << 40, "f", t(6), "DE"), (7, "a", t(7), "FR")],
                                        "user_id bigint, user_name string, updated_at timestamp_ntz, country string"), layout.bronze("e"))
    out = run_silver(spark, spec, layout)
    want = [("a", 1, None), ("b", 2, None), ("c", None, None), ("d", None, None), ("e", 5, None), ("f", None, "DE")]
    assert sorted((r.user_name, r.user_id, r.country) for r in out.collect()) == want
    assert "_rescued_data" not in out.columns and spark.table("silver_rescue").count() == 6
    assert table_stream(spark, spec, layout).columns == out.columns
    spark.sql("DROP TABLE silver_rescue")


def test_values_of_every_kind_fit_or_are_rescued(spark):
    from pyspark.sql import types as T
    from tidemark.streaming.silver import fitted
    src = spark.createDataFrame([(1.0, 1 << 40, "2025-01-02", [1, 2], True), (1.5, 7, "never", None, None)],
                                "a double, b bigint, c string, d array<int>, e boolean")
    want = T._parse_datatype_string("a int, b int, c date, d string, e date, f string")
    rows = fitted(src, want).collect()
    assert [tuple(r)[:6] for r in rows] == [(1, None, dt.date(2025, 1, 2), "[1,2]", None, None), (None, 7, None, None, None, None)]
    assert [r._rescued_data for r in rows] == ['{"b":1099511627776,"e":true}', '{"a":1.5,"c":"never"}']


def test_without_rescue_a_changed_type_ends_the_run(spark, layout):
    _drift(spark, layout, "w", (0,))
    run_silver(spark, SilverSpec(table="w"), layout)
    _drift(spark, layout, "w", (1,))
    with pytest.raises(ValueError, match="rescue"):
        run_silver(spark, SilverSpec(table="w"), layout)
    with pytest.raises(ValueError, match="reset_silver"):
        run_silver(spark, SilverSpec(table="w", rescue=True), layout)


def test_namespace_names_silver_tables(spark, layout):
    from tidemark.config import Namespace
    append_bronze(spark.createDataFrame([(1, "a", t(1))], SCHEMA), layout.bronze("ns_users"))
    spark.sql("CREATE DATABASE IF NOT EXISTS silver_ns")
    run_silver(spark, SilverSpec(table="ns_users"), layout, Namespace(schema="silver_ns"))
    assert spark.table("silver_ns.ns_users").count() == 1
    spark.sql("DROP DATABASE silver_ns CASCADE")

"""Gold targets: stops at every step, schema changes, reserved names, catalog names."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import fs
from tidemark.config import JoinSpec, Namespace
from tidemark.operators.star import star_join
from tidemark.plans.declare import Registry
from tidemark.streaming import live as L
from tidemark.streaming.gold import CdcFlow, merge_batch, read_target, register_target

SCHEMA = "k int, s timestamp_ntz, v string"


def t(d):
    return dt.datetime(2025, 1, 1) + dt.timedelta(hours=d)


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


FIRST = [(k, t(0), "a") for k in range(40)]
SECOND = [(k, t(1 + k), "b") for k in (0, 1, 2, 50)]


@pytest.mark.parametrize("scd,except_cols", [(1, None), (2, None), (2, ["s"])])
@pytest.mark.parametrize("step", ["stage", "publish", "pointer", "cleanup"])
def test_a_stop_at_any_step_is_made_good_by_the_replay(spark, root, monkeypatch, scd, except_cols, step):
    flow = CdcFlow("t", "s", ["k"], "s", scd, except_cols, buckets=3)
    for where in ("clean", "stopped"):
        merge_batch(spark, frame(spark, FIRST), flow, f"{root}/{where}", 0)
    merge_batch(spark, frame(spark, SECOND), flow, f"{root}/clean", 1)

    def stop(*a, **b):
        raise KeyboardInterrupt("stopped")

    before = read_target(spark, f"{root}/stopped").collect()
    with monkeypatch.context() as m:
        if step == "stage":
            real = L.stage
            m.setattr(L, "stage", lambda *a: (real(*a), stop()))
        elif step == "publish":
            m.setattr(L, "publish", stop)
        elif step == "pointer":
            m.setattr(L.fs, "write_text", stop)
        else:
            m.setattr(L.fs, "list_dirs", lambda s, p, real=fs.list_dirs, seen=[]: (
                stop() if p.endswith("/data") else real(s, p)))
        with pytest.raises(KeyboardInterrupt):
            merge_batch(spark, frame(spark, SECOND), flow, f"{root}/stopped", 1)
    now = read_target(spark, f"{root}/stopped").collect()
    want = read_target(spark, f"{root}/clean").collect()
    key = lambda rows: sorted(map(str, rows))
    assert key(now) in (key(before), key(want))   # as it was, or as it should be
    merge_batch(spark, frame(spark, SECOND), flow, f"{root}/stopped", 1)
    assert key(read_target(spark, f"{root}/stopped").collect()) == key(want)


def test_columns_come_and_go_and_change_type(spark, root):
    flow = CdcFlow("t", "s", ["k"], "s", 1, buckets=4)
    merge_batch(spark, frame(spark, [(k, t(0), "a") for k in range(8)]), flow, root, 0)
    merge_batch(spark, frame(spark, [(1, t(1), "a", 7)], SCHEMA + ", c int"), flow, root, 1)
    merge_batch(spark, frame(spark, [(2, t(2), "b")]), flow, root, 2)
    merge_batch(spark, frame(spark, [(3, t(3), "c", 1 << 40)], SCHEMA + ", c long"), flow, root, 3)
    merge_batch(spark, frame(spark, [(4, t(4), "d", "text")], SCHEMA + ", c string"), flow, root, 4)
    out = {r.k: (r.v, r.c) for r in read_target(spark, root).collect()}
    assert out == {0: ("a", None), 1: ("a", "7"), 2: ("b", None), 3: ("c", str(1 << 40)), 4: ("d", "text"),
                   5: ("a", None), 6: ("a", None), 7: ("a", None)}


def test_reserved_names_are_refused_and_others_kept(spark, root):
    flow = CdcFlow("t", "s", ["k"], "s", 1, buckets=2)
    with pytest.raises(ValueError, match="__bucket"):
        merge_batch(spark, frame(spark, FIRST).withColumn("__bucket", F.lit(1)), flow, root, 0)
    merge_batch(spark, frame(spark, FIRST).withColumn("__op", F.lit("u")), flow, root, 0)
    assert read_target(spark, root).columns == ["k", "s", "v", "__op"]


def test_old_folders_go(spark, root):
    flow = CdcFlow("t", "s", ["k"], "s", 1, buckets=2)
    for i in range(4):
        merge_batch(spark, frame(spark, [(k, t(i), str(i)) for k in range(10)]), flow, root, i)
    assert len(fs.list_dirs(spark, f"{root}/data")) == 2   # the live one and the one before


def test_target_by_name_follows_merges_columns_and_types(spark, root):
    """A name given once shows every later merge: moved buckets, new buckets, new
    columns, wider types and a whole rewrite; queries built before still work."""
    flow = CdcFlow("t", "s", ["k"], "s", 2, buckets=3)
    merge_batch(spark, frame(spark, FIRST[:1]), flow, root, 0)
    register_target(spark, root, "live_name_test")
    register_target(spark, root, "live_name_test")   # again: no harm
    merge_batch(spark, frame(spark, FIRST[1:]), flow, root, 1)
    assert spark.table("live_name_test").count() == 40
    merge_batch(spark, frame(spark, [(0, t(5), "z", 1)], SCHEMA + ", c int"), flow, root, 2)
    got = spark.sql("SELECT k, v, c FROM live_name_test WHERE k = 0 ORDER BY s").collect()
    assert [(r.v, r.c) for r in got] == [("a", None), ("z", 1)]
    for i, (k, c, kind) in enumerate([(1, 1 << 40, "long"), (2, "text", "string"), (3, "more", "string")]):
        merge_batch(spark, frame(spark, [(k, t(6), "y", c)], SCHEMA + f", c {kind}"), flow, root, 3 + i)
        by_name, by_path = (sorted(map(str, df.collect())) for df in (spark.table("live_name_test"), read_target(spark, root)))
        assert by_name == by_path and len(by_name) == 42 + i
    L.unregister(spark, root, "live_name_test")
    merge_batch(spark, frame(spark, [(1, t(9), "last", "x")], SCHEMA + ", c string"), flow, root, 9)
    assert not spark.catalog.tableExists("live_name_test") and read_target(spark, root).count() == 45


def test_an_old_state_of_a_name_is_brought_up_to_date(spark, root, monkeypatch):
    """A catalog that missed merges (another session's) gets them with the next one."""
    flow = CdcFlow("t", "s", ["k"], "s", 1, buckets=4)
    merge_batch(spark, frame(spark, FIRST), flow, root, 0)
    register_target(spark, root, "live_missed_test")
    with monkeypatch.context() as m:
        m.setattr(L, "names", lambda *a: [])
        for i in (1, 2, 3):
            merge_batch(spark, frame(spark, [(k, t(i), str(i)) for k in range(i, 50, 3)]), flow, root, i)
    merge_batch(spark, frame(spark, [(0, t(9), "z")]), flow, root, 4)
    assert sorted(map(str, spark.table("live_missed_test").collect())) == sorted(map(str, read_target(spark, root).collect()))
    L.unregister(spark, root, "live_missed_test")


KINDS = [("tinyint", "smallint"), ("int", "bigint"), ("int", "double"), ("float", "double"), ("date", "timestamp_ntz"),
         ("int", "string"), ("bigint", "decimal(20,0)"), ("decimal(10,2)", "decimal(12,2)"), ("date", "string"),
         ("timestamp_ntz", "string")]


@pytest.mark.parametrize("old,new,scd,except_cols", [(*k, 2, None) for k in KINDS] + [
    (*k, *form) for k in (("int", "bigint"), ("int", "string")) for form in ((1, None), (2, ["s", "v"]))])
def test_a_key_keeps_its_rows_when_its_type_changes(spark, root, scd, except_cols, old, new):
    """Old keys, then a batch of the new type touching two of them and a new one."""
    flow = CdcFlow("t", "s", ["k"], "s", scd, except_cols, buckets=16)
    key = F.date_add(F.lit("2025-01-01").cast("date"), F.col("id").cast("int")) if old in ("date", "timestamp_ntz") else F.col("id")

    def batch(ks, kind, s, v):
        ids = spark.createDataFrame([(k,) for k in ks], "id long")
        return ids.select(key.cast(old).cast(kind).alias("k"), F.lit(s).cast("timestamp_ntz").alias("s"), F.lit(v).alias("v"))

    merge_batch(spark, batch(range(20), old, "2025-02-01", "a"), flow, root, 0)
    m = merge_batch(spark, batch([3, 7, 25], new, "2025-02-02", "b"), flow, root, 1)
    out = read_target(spark, root)
    kept = 21 if scd == 1 or except_cols else 23   # ignored columns open no version
    assert out.count() == kept and out.select("k").distinct().count() == 21
    assert out.schema["k"].dataType.simpleString() == new
    open_ = out if scd == 1 else out.where("__END_AT IS NULL")
    assert open_.count() == 21 and open_.where("v = 'b'").count() == 3
    assert m["rewritten"] == ((old, new) not in (("tinyint", "smallint"), ("int", "bigint"), ("float", "double"),
                                                 ("date", "timestamp_ntz")))


def test_targets_bucketed_without_canonical_keys_are_rewritten_once(spark, root):
    flow = CdcFlow("t", "s", ["k"], "s", 1, buckets=16)
    merge_batch(spark, frame(spark, FIRST), flow, root, 0)
    live = L.latest(spark, root)
    live.keys, live.number = [], live.number + 1
    import json
    fs.write_text(spark, f"{root}/_live/{live.number:012d}.json", json.dumps(live.__dict__))
    assert merge_batch(spark, frame(spark, SECOND), flow, root, 1)["rewritten"]
    assert not merge_batch(spark, frame(spark, SECOND), flow, root, 2)["rewritten"]
    assert read_target(spark, root).count() == 41


def test_registry_builds_what_is_read_and_refuses_cycles_and_equal_names(spark, layout):
    reg, order = Registry(), []

    def build(name, *reads):
        def fn(s):
            for r in reads:
                reg.read(s, r)
            order.append(name)
            return frame(spark, FIRST)
        return fn

    reg.table(build("b", "a"), name="b")
    reg.table(build("a"), name="a")
    reg.table(build("c"), name="c", reads=["a"])
    reg.run(spark, layout)
    assert order == ["a", "b", "c"]
    reg.table(build("a", "b"), name="a")
    with pytest.raises(ValueError, match="each other: b -> a -> b"):
        reg.run(spark, layout)
    reg.table(build("a", "nothing"), name="a")
    with pytest.raises(ValueError, match="'nothing' is not a declared table"):
        reg.run(spark, layout)
    reg.create_streaming_table("x")
    reg.create_auto_cdc_flow("x", "b", ["k"], "s")
    with pytest.raises(ValueError, match="name"):
        reg.create_auto_cdc_flow("x", "a", ["k"], "s")


def test_snapshots_of_a_batch_table(spark, layout):
    """Every run leaves a snapshot that was written whole; readers see the last one, the
    metrics have all; older ones but the previous go."""
    for i in range(4):
        reg = Registry()
        reg.table(Registry.expect_all_or_drop({"low": f"k < {10 + i}"})(lambda s: frame(spark, FIRST)), name="snap_t")
        reg.run(spark, layout, Namespace(schema="default"))
        assert reg.read(spark, "snap_t").count() == 10 + i == spark.table("default.snap_t").count()
    path = reg._dataset_path(layout, "snap_t")
    assert reg._snapshots(spark, layout, "snap_t") == [2, 3]
    fs.write_text(spark, f"{path}/__batch=4/part-0.parquet", "a run that stopped")
    assert reg.read(spark, "snap_t").count() == 13
    got = reg.dataset_metrics(spark, layout).orderBy("batch").collect()
    assert [(r.dataset, r.batch, r.rows_in, r.rows_out, r.failed) for r in got] == [
        ("snap_t", i, 40, 10 + i, {"low": 30 - i}) for i in range(4)]
    reg.run(spark, layout)
    assert reg.read(spark, "snap_t").count() == 13
    spark.sql("DROP TABLE default.snap_t")


def test_once_flow_over_a_stream(spark, layout):
    from tidemark.streaming.gold import run_flow
    path = f"{layout.root}/src"
    frame(spark, FIRST).write.parquet(path)
    src = spark.readStream.schema(frame(spark, FIRST).schema).parquet(path)
    flow = CdcFlow("t", "s", ["k"], "s", 1, once=True, buckets=2)
    run_flow(spark, src, flow, f"{layout.root}/t", f"{layout.root}/cp")
    assert read_target(spark, f"{layout.root}/t").count() == 40


def test_a_join_without_equality_needs_a_bounded_side(spark):
    facts, bands = spark.range(10), spark.createDataFrame([(0, 4), (5, 9)], "lo int, hi int")
    tables = {"f": facts, "b": bands}
    first = JoinSpec("f", "f", ["f.id"])
    with pytest.raises(ValueError, match="bounded"):
        star_join([first, JoinSpec("b", "b", ["b.lo"], "f.id BETWEEN b.lo AND b.hi")], tables.__getitem__)
    theta = JoinSpec("b", "b", ["b.lo"], "f.id BETWEEN b.lo AND b.hi", bounded=True)
    out = star_join([first, theta], tables.__getitem__)
    assert out.count() == 10 and Namespace(schema="a").qualify("b") == "a.b"
    # a plain equality behind a bounded range is no fault of its own
    both = [first, theta, JoinSpec("f", "g", ["g.id"], "f.id = g.id")]
    assert star_join(both, tables.__getitem__).count() == 10
    # a side that is larger than it says is not sent: fine with an equality, refused without
    with pytest.raises(ValueError, match="max_rows=1"):
        star_join([first, JoinSpec("b", "b", ["b.lo"], "f.id BETWEEN b.lo AND b.hi", bounded=True, max_rows=1)], tables.__getitem__)
    plan = star_join([first, JoinSpec("f", "g", ["g.id"], "f.id = g.id", bounded=True, max_rows=5)], tables.__getitem__)
    assert plan.count() == 10 and "ResolvedHint (strategy=broadcast)" not in plan._jdf.queryExecution().analyzed().toString()

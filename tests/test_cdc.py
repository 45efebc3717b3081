"""SCD1 / SCD2 against brute-force Python references on small fixtures."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import cdc
from tidemark.operators.cdc import (closed_versions, current_versions, lineage, resolve_ties,
                                    scd1_latest, scd2_versions)
from tidemark.streaming.gold import CdcFlow, merge_batch, read_target

from conftest import rows

SCHEMA = "k int, seq timestamp_ntz, a string, b int"


def t(h):
    return dt.datetime(2025, 1, 1) + dt.timedelta(hours=h)


def brute_scd2(events, except_cols=None):
    """events: list of (k, seq, a, b). Reference implementation in Python."""
    best = {}
    for e in events:
        if e[1] is None:
            continue
        key = (e[0], e[1])
        best[key] = max(best.get(key, e), e, key=lambda r: (r[2] is not None, r[2], r[3] is not None, r[3]))
    by_key = {}
    for (k, s), e in best.items():
        by_key.setdefault(k, []).append(e)
    out = []
    names = ["k", "seq", "a", "b"]
    tracked = [i for i, n in enumerate(names) if n != "k" and (except_cols is None or n not in except_cols)]
    for k, evs in by_key.items():
        evs.sort(key=lambda r: r[1])
        versions = []
        for e in evs:
            if except_cols is not None and versions and all(versions[-1][1][i] == e[i] for i in tracked):
                versions[-1] = (versions[-1][0], e)          # update in place, keep start
            else:
                versions.append((e[1], e))
        for i, (start, e) in enumerate(versions):
            end = versions[i + 1][0] if i + 1 < len(versions) else None
            out.append((*e, start, end))
    return sorted(out, key=repr)


def brute_scd1(events):
    return sorted({r[:4] for r in brute_scd2(events) if r[5] is None}, key=repr)


def test_late_event_lands_in_place(spark):
    ev = spark.createDataFrame([(1, t(1), "A", 1), (1, t(3), "C", 3), (1, t(2), "B", 2)], SCHEMA)
    out = rows(scd2_versions(ev, ["k"], "seq"), ["a", "__START_AT", "__END_AT"])
    assert out == [("A", t(1), t(2)), ("B", t(2), t(3)), ("C", t(3), None)]


def test_late_event_inside_collapsed_run(spark, root):
    flow = CdcFlow(target="x", source="y", keys=["k"], sequence_by="seq", stored_as_scd_type=2,
                   track_history_except_column_list=["seq", "b"], buckets=4)
    first = spark.createDataFrame([(1, t(1), "A", 1), (1, t(3), "A", 3)], SCHEMA)
    merge_batch(spark, first, flow, root, 0)
    assert read_target(spark, root).count() == 1
    merge_batch(spark, spark.createDataFrame([(1, t(2), "B", 2)], SCHEMA), flow, root, 1)
    out = rows(read_target(spark, root), ["a", "b", "__START_AT", "__END_AT"])
    assert out == [("A", 1, t(1), t(2)), ("A", 3, t(3), None), ("B", 2, t(2), t(3))]


def test_duplicate_event_is_one_version_and_ties_are_deterministic(spark):
    ev = [(1, t(1), "A", 1), (1, t(1), "A", 1), (1, t(2), "B", 1), (1, t(2), "C", 0)]
    for perm in range(3):
        random.Random(perm).shuffle(ev)
        df = spark.createDataFrame(ev, SCHEMA).repartition(3)
        assert rows(scd2_versions(df, ["k"], "seq")) == brute_scd2(ev)
    assert rows(resolve_ties(spark.createDataFrame(ev, SCHEMA), ["k"], "seq"), ["a"]) == [("A",), ("C",)]


def test_null_key_is_one_key_and_null_sequence_is_skipped(spark):
    ev = [(None, t(1), "A", 1), (None, t(2), "B", 2), (2, None, "Z", 0)]
    df = spark.createDataFrame(ev, SCHEMA)
    assert rows(scd2_versions(df, ["k"], "seq")) == brute_scd2(ev)
    assert rows(scd1_latest(df, ["k"], "seq")) == [(None, t(2), "B", 2)]


def test_history_queries(spark):
    ev = spark.createDataFrame([(1, t(1), "A", 1), (1, t(2), "B", 2), (2, t(1), "C", 1)], SCHEMA)
    v = scd2_versions(ev, ["k"], "seq")
    assert closed_versions(v).count() == 1
    assert current_versions(v).count() == 2
    assert lineage(v, "k", [1]).count() == 2


SEQUENCES = ["timestamp_ntz", "timestamp", "date", "int", "bigint", "double", "decimal(12,3)", "string", "binary"]


@pytest.mark.parametrize("kind,except_cols", [(k, None) for k in SEQUENCES] + [(k, ["seq", "b"]) for k in ("timestamp_ntz", "string")])
def test_hot_keys_are_split_by_measured_cuts(spark, kind, except_cols):
    """Keys over the limit are split, others are not; same versions as brute force."""
    from pyspark.sql import functions as F
    ev = [(1, t(h), "A" if (h // 5) % 2 else "B", h) for h in range(0, 90)]
    ev += [(1, t(40), "A", 1), (None, t(7), "N", 0)] + [(None, t(h), "N", h) for h in range(10, 60, 2)]
    ev += [(2, t(h), "X", h) for h in (0, 30, 31)]
    df = spark.createDataFrame(ev, SCHEMA).repartition(5)
    hour = (F.unix_seconds(F.col("seq").cast("timestamp")) / 3600).cast("int")
    as_kind = {"date": F.date_add(F.lit("2025-01-01").cast("date"), hour % 10_000), "string": F.lpad(hour.cast("string"), 9, "0"),
               "binary": F.lpad(hour.cast("string"), 9, "0").cast("binary"), "timestamp": F.col("seq").cast("timestamp")}
    typed = df if kind == "timestamp_ntz" else df.withColumn("seq", as_kind.get(kind, hour).cast(kind))
    chunks = {(r.k, r["__chunk"]) for r in cdc._keyed(typed, ["k"], "seq", 20)[0].collect()}
    split = kind != "binary"
    assert (2, -1) in chunks and ((1, -1) not in chunks and len(chunks) > 30) == split
    whole = rows(scd2_versions(typed, ["k"], "seq", except_cols))
    assert rows(scd2_versions(typed, ["k"], "seq", except_cols, hot_rows=20)) == whole
    if kind == "timestamp_ntz":
        assert whole == brute_scd2(ev, except_cols)


events_strategy = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 40), st.sampled_from(["A", "B"]), st.integers(0, 2)),
    min_size=1, max_size=25)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(events=events_strategy, splits=st.integers(1, 3), seed=st.integers(0, 10_000))
def test_incremental_equals_batch_for_any_split_and_order(spark, events, splits, seed):
    """Property: the SCD result does not depend on batch boundaries or the
    order batches arrive in (and replaying a batch changes nothing)."""
    from tidemark.session import scratch
    ev = [(k, t(h), a, b) for k, h, a, b in events]
    rnd = random.Random(seed)
    rnd.shuffle(ev)
    cuts = sorted(rnd.sample(range(1, len(ev)), min(splits - 1, len(ev) - 1))) if len(ev) > 1 else []
    batches = [ev[i:j] for i, j in zip([0] + cuts, cuts + [len(ev)])]
    for scd, exc in ((1, None), (2, None), (2, ["seq", "b"])):
        root = scratch(spark, "prop")
        flow = CdcFlow(target="x", source="y", keys=["k"], sequence_by="seq", stored_as_scd_type=scd,
                       track_history_except_column_list=exc, buckets=3)
        for i, b in enumerate(batches):
            merge_batch(spark, spark.createDataFrame(b, SCHEMA), flow, root, i)
        merge_batch(spark, spark.createDataFrame(batches[0], SCHEMA), flow, root, 0)  # replay
        got = read_target(spark, root)
        want = brute_scd1(ev) if scd == 1 else brute_scd2(ev, exc)
        cols = ["k", "seq", "a", "b"] + ([] if scd == 1 else ["__START_AT", "__END_AT"])
        assert rows(got, cols) == want, (scd, exc)


def test_range_buckets_touch_only_recent_buckets(spark, root):
    """Growing keys with range buckets: a batch of new keys leaves the
    existing buckets alone (and the result equals the batch computation)."""
    flow = CdcFlow(target="f", source="s", keys=["k"], sequence_by="seq", stored_as_scd_type=1,
                   bucket_width=10)
    first = [(k, t(k), "A", k) for k in range(0, 30)]
    merge_batch(spark, spark.createDataFrame(first, SCHEMA), flow, root, 0)
    later = [(k, t(k), "B", k) for k in range(30, 35)] + [(29, t(99), "late", 0)]
    m = merge_batch(spark, spark.createDataFrame(later, SCHEMA), flow, root, 1)
    assert m["buckets_touched"] == 2   # buckets 2 (key 29) and 3 (keys 30-34)
    assert rows(read_target(spark, root), ["k", "seq", "a", "b"]) == brute_scd1(first + later)


def test_small_batch_recomputes_only_its_keys(spark):
    """A small batch against a long history: stored rows of untouched keys
    are copied, touched keys (a NULL key, late events, an event inside a
    collapsed run) are recomputed; same result as brute force, and as the
    whole-bucket recompute."""
    from tidemark.session import scratch
    history = [(k, t(h), "A" if (h // 3) % 2 else "B", h % 4) for k in range(40) for h in range(0, 12, 2)]
    history += [(None, t(h), "N", h) for h in (1, 5)]
    late = [(3, t(3), "Q", 0), (7, t(20), "B", 1), (None, t(2), "M", 9),
            (11, t(5), "A" if (4 // 3) % 2 else "B", 3)]   # same values as its run: no new version
    for scd, exc in ((1, None), (2, None), (2, ["seq", "b"])):
        outs = []
        for bmax in (1_000_000, 0):
            root = scratch(spark, "small_batch")
            flow = CdcFlow(target="x", source="y", keys=["k"], sequence_by="seq", stored_as_scd_type=scd,
                           track_history_except_column_list=exc, buckets=2, broadcast_keys_max=bmax)
            merge_batch(spark, spark.createDataFrame(history, SCHEMA), flow, root, 0)
            m = merge_batch(spark, spark.createDataFrame(late, SCHEMA), flow, root, 1)
            assert m["split_by_keys"] is (bmax > 0), (scd, exc, m)
            cols = ["k", "seq", "a", "b"] + ([] if scd == 1 else ["__START_AT", "__END_AT"])
            outs.append(rows(read_target(spark, root), cols))
        want = brute_scd1(history + late) if scd == 1 else brute_scd2(history + late, exc)
        assert outs[0] == want and outs[1] == want, (scd, exc)


def test_batch_touching_most_keys_recomputes_buckets_whole(spark, root):
    """When most stored rows belong to keys the batch touches, splitting
    saves nothing: the touched buckets are recomputed whole (same result)."""
    history = [(k, t(h), "A", h) for k in range(20) for h in range(0, 6, 2)]
    later = [(k, t(7), "B", 7) for k in range(18)]
    flow = CdcFlow(target="x", source="y", keys=["k"], sequence_by="seq", stored_as_scd_type=2, buckets=2)
    merge_batch(spark, spark.createDataFrame(history, SCHEMA), flow, root, 0)
    m = merge_batch(spark, spark.createDataFrame(later, SCHEMA), flow, root, 1)
    assert m["split_by_keys"] is False
    cols = ["k", "seq", "a", "b", "__START_AT", "__END_AT"]
    assert rows(read_target(spark, root), cols) == brute_scd2(history + later)

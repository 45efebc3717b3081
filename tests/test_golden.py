"""Golden end-to-end run: two source states through ingest -> bronze ->
silver streams -> declared gold flows, then the reporting join.

Expected numbers are the published ones (gold dimension date 365, track 502,
user 500, fact 1,000) and those that follow from the seed profile."""

from pyspark.sql import functions as F

from tidemark.config import JoinSpec, SourceTable
from tidemark.operators.cdc import closed_versions, scd2_versions
from tidemark.operators.star import star_join
from tidemark.operators.transforms import clean_tracks, clean_users, drop_rescued
from tidemark.plans.declare import Registry
from tidemark.plans.ingest import ingest_all
from tidemark.sources.relational import frame_reader
from tidemark.sources.watermark import read_watermark
from tidemark.streaming.gold import merge_batch, read_target, upsert_report, CdcFlow
from tidemark.streaming.silver import SilverSpec, run_silver, read_silver
from tidemark.session import scratch

import seed

CONFIGS = [SourceTable("dim_user", "updated_at", keys=("user_id",)),
           SourceTable("dim_track", "updated_at", keys=("track_id",)),
           SourceTable("dim_date", "date", keys=("date_key",)),
           SourceTable("dim_artist", "updated_at", keys=("artist_id",)),
           SourceTable("fact_stream", "stream_timestamp", keys=("stream_id",))]

SILVER = {"dim_user": SilverSpec("dim_user", clean_users, ["user_id"]),
          "dim_artist": SilverSpec("dim_artist", drop_rescued, ["artist_id"]),
          "dim_track": SilverSpec("dim_track", clean_tracks),
          "dim_date": SilverSpec("dim_date", drop_rescued),
          "fact_stream": SilverSpec("fact_stream", drop_rescued)}

RULES = {"rule_1": "user_id IS NOT NULL"}


def _registry(spark, layout):
    reg = Registry()

    def staging(name):
        def fn(s):
            schema = read_silver(s, SILVER[name], layout).schema
            return s.readStream.schema(schema).parquet(layout.silver_data(name))
        return fn

    reg.table(Registry.expect_all_or_drop(RULES)(staging("dim_user")), name="dimuser_stg")
    for n in ("dim_track", "dim_date", "fact_stream"):
        reg.table(staging(n), name=n.replace("_", "") + "_stg")
    reg.create_streaming_table("dimuser", expect_all_or_drop=RULES, buckets=8)
    for t in ("dimtrack", "dimdate", "factstream"):
        reg.create_streaming_table(t, buckets=8)
    reg.create_auto_cdc_flow("dimuser", "dimuser_stg", ["user_id"], "updated_at", 2)
    reg.create_auto_cdc_flow("dimtrack", "dimtrack_stg", ["track_id"], "updated_at", 2)
    reg.create_auto_cdc_flow("dimdate", "dimdate_stg", ["date_key"], "date", 2)
    reg.create_auto_cdc_flow("factstream", "factstream_stg", ["stream_id"], "stream_timestamp", 1)
    return reg


def test_golden_run_a(spark, layout):
    s = seed.build()
    init = {t: spark.createDataFrame(rows, s["schemas"][t]) for t, rows in s["initial"].items()}
    both = {t: init[t].unionByName(spark.createDataFrame(s["incremental"][t], s["schemas"][t]))
            for t in init}
    bronze_counts = []
    gold = {}
    staged_rules = []
    for state in (init, both, both):
        rep = ingest_all(spark, CONFIGS, frame_reader(state), layout)
        bronze_counts.append({r.table_name: r.rows_read for r in rep.collect()})
        for spec in SILVER.values():
            run_silver(spark, spec, layout)
        reg = _registry(spark, layout)
        gold = reg.run(spark, layout)
        staged_rules.append(reg.metrics.get("dimuser_stg", []))
    # the published run view: records upserted per gold table
    ups = {r.target: r.rows_upserted for r in upsert_report(
        spark, {t: layout.gold(t) for t in ("dimdate", "dimtrack", "dimuser", "factstream")}).collect()}
    assert ups == {"dimdate": 365, "dimtrack": 502, "dimuser": 500, "factstream": 1000}
    # staging rule counters (observed metrics of the staging stream): nothing violates the rule
    assert sum(m["rows_in"] for m in staged_rules[0]) == 500
    assert all(m["failed_rule_1"] == 0 for ms in staged_rules for m in ms)
    assert bronze_counts[0] == {"dim_user": 500, "dim_track": 500, "dim_date": 365,
                                "dim_artist": 500, "fact_stream": 1000}
    assert bronze_counts[1] == {"dim_user": 20, "dim_track": 2, "dim_date": 0,
                                "dim_artist": 1, "fact_stream": 0}
    assert bronze_counts[2] == {t: 0 for t in bronze_counts[0]}
    assert read_watermark(spark, layout.watermark("dim_date")) == "2025-10-06"
    assert read_watermark(spark, layout.watermark("fact_stream")) == "2025-10-07 19:49:56.000000"
    silver = {t: read_silver(spark, spec, layout) for t, spec in SILVER.items()}
    assert {t: df.count() for t, df in silver.items()} == {
        "dim_user": 500, "dim_artist": 500, "dim_track": 502, "dim_date": 365, "fact_stream": 1000}
    assert {t: df.count() for t, df in gold.items()} == {
        "dimuser": 500, "dimtrack": 502, "dimdate": 365, "factstream": 1000}
    assert closed_versions(gold["dimtrack"]).count() == 2
    assert sorted(r.track_id for r in closed_versions(gold["dimtrack"]).collect()) == [5, 46]
    assert closed_versions(gold["dimuser"]).count() == 0
    assert gold["dimtrack"].where(F.col("track_id").isin(46, 5)).count() == 4
    # the reporting join over silver: duplicate track versions multiply facts
    specs = [JoinSpec("fact", "factstream", ["factstream.stream_id", "factstream.listen_duration"]),
             JoinSpec("user", "dimuser", ["dimuser.user_id", "dimuser.user_name"],
                      "factstream.user_id = dimuser.user_id"),
             JoinSpec("track", "dimtrack", ["dimtrack.track_id", "dimtrack.track_name"],
                      "factstream.track_id = dimtrack.track_id")]
    tables = {"fact": silver["fact_stream"], "user": silver["dim_user"], "track": silver["dim_track"]}
    assert star_join(specs, tables.__getitem__).count() == 1006
    # dedup off for users: every late row is a new version; excluding
    # updated_at from history collapses the two rows that change nothing else
    bronze_users = clean_users(spark.read.parquet(layout.bronze("dim_user")))
    v = scd2_versions(bronze_users, ["user_id"], "updated_at")
    assert (v.count(), closed_versions(v).count()) == (520, 20)
    v2 = scd2_versions(bronze_users, ["user_id"], "updated_at", ["updated_at"])
    assert (v2.count(), closed_versions(v2).count()) == (518, 18)


def test_golden_run_b_all_rows_late_data(spark):
    """Every row of both loads straight into the flows, incremental rows
    after the initial ones (many of them older than what is stored)."""
    s = seed.build()
    cases = [("dim_user", ["user_id"], "updated_at", 2, 570, 70),
             ("dim_track", ["track_id"], "updated_at", 2, 550, 50),
             ("dim_artist", ["artist_id"], "updated_at", 2, 550, 50),
             ("fact_stream", ["stream_id"], "stream_timestamp", 1, 1000, None)]
    for table, keys, seq, scd, n_rows, n_closed in cases:
        root = scratch(spark, f"golden_b_{table}")
        flow = CdcFlow(target=table, source=table, keys=keys, sequence_by=seq,
                       stored_as_scd_type=scd, buckets=8)
        for i, load in enumerate(("initial", "incremental")):
            merge_batch(spark, spark.createDataFrame(s[load][table], s["schemas"][table]), flow, root, i)
        out = read_target(spark, root)
        assert out.count() == n_rows, table
        if n_closed is not None:
            assert closed_versions(out).count() == n_closed, table

import datetime as dt

from pyspark.sql import functions as F

from tidemark.config import SourceTable
import pytest

from tidemark.plans.ingest import FAILED, NO_DATA, SUCCEEDED, failures, ingest_all, ingest_table
from tidemark.sources.extract import window_stats
from tidemark.sources.relational import frame_reader
from tidemark.sources.watermark import read_watermark, watermark_history, write_watermark
from tidemark import fs

from conftest import rows

USERS = SourceTable(table="dim_user", cdc_col="updated_at", keys=("user_id",))
DATES = SourceTable(table="dim_date", cdc_col="date", keys=("date_key",))


def _users(spark, data):
    return spark.createDataFrame(data, "user_id int, name string, updated_at timestamp_ntz")


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_first_run_loads_all_non_null(spark, layout):
    src = _users(spark, [(1, "a", ts("2025-01-01 10:00:00")), (2, "b", None),
                         (3, "c", ts("2025-01-02 10:00:00"))])
    r = ingest_table(spark, USERS, frame_reader({"dim_user": src}), layout)
    assert r.status == SUCCEEDED and r.rows_read == 2
    assert r.watermark == "2025-01-02 10:00:00.000000"
    assert read_watermark(spark, layout.watermark("dim_user")) == r.watermark
    assert sorted(x.user_id for x in spark.read.parquet(layout.bronze("dim_user")).collect()) == [1, 3]


def test_equal_to_mark_and_null_are_not_extracted(spark, layout):
    write_watermark(spark, layout.watermark("dim_user"), "2025-01-02 10:00:00.000000", "r0", "seed")
    src = _users(spark, [(1, "a", ts("2025-01-02 10:00:00")), (2, "b", None),
                         (3, "c", ts("2025-01-02 10:00:00.000001"))])
    r = ingest_table(spark, USERS, frame_reader({"dim_user": src}), layout)
    assert r.rows_read == 1
    assert [x.user_id for x in spark.read.parquet(layout.bronze("dim_user")).collect()] == [3]
    assert r.watermark == "2025-01-02 10:00:00.000001"


def test_no_new_rows_writes_nothing_and_keeps_mark(spark, layout):
    src = _users(spark, [(1, "a", ts("2025-01-01 10:00:00"))])
    reader = frame_reader({"dim_user": src})
    ingest_table(spark, USERS, reader, layout)
    files_before = fs.list_names(spark, layout.bronze("dim_user"))
    r = ingest_table(spark, USERS, reader, layout)
    assert r.status == NO_DATA and r.rows_read == 0
    assert fs.list_names(spark, layout.bronze("dim_user")) == files_before
    assert read_watermark(spark, layout.watermark("dim_user")) == "2025-01-01 10:00:00.000000"
    assert watermark_history(spark, layout.watermark("dim_user")).count() == 1


def test_empty_from_date_uses_stored_mark_and_backfill_overrides(spark, layout):
    src = _users(spark, [(i, "x", ts(f"2025-01-0{i} 00:00:00")) for i in range(1, 6)])
    reader = frame_reader({"dim_user": src})
    write_watermark(spark, layout.watermark("dim_user"), "2025-01-03 00:00:00", "r0", "seed")
    r = ingest_table(spark, USERS, reader, layout, from_date="")
    assert r.low_mark == "2025-01-03 00:00:00" and r.rows_read == 2
    # backfill: earlier from_date re-extracts, and the mark is the window max again
    r2 = ingest_table(spark, USERS, reader, layout, from_date="2025-01-01")
    assert r2.rows_read == 4 and r2.watermark == "2025-01-05 00:00:00.000000"
    assert spark.read.parquet(layout.bronze("dim_user")).count() == 6


def test_date_change_column(spark, layout):
    src = spark.createDataFrame([(20250101, dt.date(2025, 1, 1)), (20250102, dt.date(2025, 1, 2))],
                                "date_key int, date date")
    reader = frame_reader({"dim_date": src})
    r = ingest_table(spark, DATES, reader, layout)
    assert r.watermark == "2025-01-02"
    assert ingest_table(spark, DATES, reader, layout).status == NO_DATA


def test_window_is_bounded_by_high(spark):
    src = _users(spark, [(1, "a", ts("2025-01-01 00:00:00")), (2, "b", ts("2025-01-03 00:00:00"))])
    st = window_stats(src, "updated_at", "2025-01-01 00:00:00")
    assert st.rows == 1 and st.high == "2025-01-03 00:00:00.000000"


def test_ingest_all_reports_failures_without_stopping(spark, layout):
    good = _users(spark, [(1, "a", ts("2025-01-01 00:00:00"))])
    bad = SourceTable(table="missing", cdc_col="updated_at")
    rep = ingest_all(spark, [bad, USERS], frame_reader({"dim_user": good}), layout, raise_on_failure=False)
    assert {r.pipeline for r in rep.collect()} == {"ingest"}
    got = {r.table_name: r.status for r in rep.collect()}
    assert got == {"missing": FAILED, "dim_user": SUCCEEDED}
    assert failures(rep).count() == 1
    assert spark.read.parquet(layout.reports()).count() == 2
    with pytest.raises(RuntimeError, match="1 table"):
        ingest_all(spark, [bad], frame_reader({"dim_user": good}), layout)


def test_parallel_ingest(spark, layout):
    a = _users(spark, [(1, "a", ts("2025-01-01 00:00:00"))])
    cfgs = [SourceTable(table=f"t{i}", cdc_col="updated_at") for i in range(3)]
    rep = ingest_all(spark, cfgs, frame_reader({f"t{i}": a for i in range(3)}), layout, max_parallel=3)
    assert rows(rep, ["table_name", "status", "rows_read"]) == [
        ("t0", SUCCEEDED, 1), ("t1", SUCCEEDED, 1), ("t2", SUCCEEDED, 1)]


def test_window_query_is_computed_by_the_database():
    from tidemark.config import SourceTable
    from tidemark.sources.relational import window_query
    cfg = SourceTable(table="t", cdc_col="c")
    assert window_query(cfg, None) == "SELECT COUNT(*) AS n, MAX(c) AS high FROM dbo.t WHERE c IS NOT NULL"
    assert window_query(cfg, "x'y").endswith("WHERE c > 'x''y'")


def test_a_reader_may_compute_the_window(spark, layout):
    from tidemark.config import SourceTable
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, c string")
    read = frame_reader({"t": df})
    read.window = lambda cfg, low: spark.createDataFrame([(2, "b")], "n long, high string")
    r = ingest_table(spark, SourceTable(table="t", cdc_col="c"), read, layout)
    assert (r.rows_read, r.watermark) == (2, "b")


def test_marks_are_cut_to_the_digits_of_their_column():
    from tidemark.sources.relational import mark_literal, window_query
    mark = "2025-10-07 19:49:55.123999"
    assert mark_literal(mark, 3) == "'2025-10-07 19:49:55.123'" and mark_literal(mark, 0) == "'2025-10-07 19:49:55'"
    assert mark_literal(mark, 6) == f"'{mark}'" and mark_literal("2025-10-07", 3) == "'2025-10-07'"
    assert window_query(SourceTable("t", "c"), mark).endswith("WHERE c > '2025-10-07 19:49:55.123'")


def test_measured_split_covers_every_key_once():
    import duckdb
    from tidemark.config import JdbcOptions
    from tidemark.sources.relational import cuts_query, jdbc_reader, range_predicates
    opts = JdbcOptions("jdbc:x", partition_column="k", num_partitions=4)
    con = duckdb.connect()   # in this process
    con.sql("CREATE SCHEMA dbo; CREATE TABLE dbo.t AS SELECT CASE WHEN i < 900 THEN 5 ELSE i END AS k FROM range(1200) x(i) "
            "UNION ALL SELECT NULL")
    for text in ("dbo.t", "(SELECT 'a''' || k AS k FROM dbo.t)"):
        cuts = [r[0] for r in con.sql(cuts_query(SourceTable("t", "c"), opts).replace("dbo.t", text)).fetchall()]
        assert len(cuts) == 4
        parts = range_predicates("k", cuts)
        counts = [con.sql(f"SELECT count(*) FROM {text} q WHERE {p}").fetchall()[0][0] for p in parts]
        assert sum(counts) == 1201 and len(parts) == len(set(cuts))
    assert range_predicates("k", [7]) == ["1 = 1"] == range_predicates("k", [])
    with pytest.raises(ValueError, match="num_partitions"):
        jdbc_reader(None, JdbcOptions("jdbc:x", partition_column="k"))
    with pytest.raises(ValueError, match="upper_bound"):
        jdbc_reader(None, JdbcOptions("jdbc:x", partition_column="k", num_partitions=3, lower_bound=1))


LATE = "k int, s timestamp_ntz, v string"


@pytest.mark.parametrize("converted", [False, True])
def test_rows_below_the_mark_are_delivered_once(spark, layout, converted):
    from pyspark.sql import types as T
    day = lambda d: dt.datetime(2025, 1, d)
    cfg = SourceTable(table="t", cdc_col="s", lookback="5 days")
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("s", T.TimestampNTZType()),
                           T.StructField("v", T.VarcharType(2))]) if converted else None

    def run(data):
        return ingest_table(spark, cfg, frame_reader({"t": spark.createDataFrame(data, LATE)}), layout, target_schema=schema)

    data = [(1, day(1), "a"), (2, day(10), None)]
    assert run(data).rows_read == 2
    data += [(3, day(7), "late"), (3, day(7), "late"), (4, day(4), "too late"), (5, day(12), "new")]
    r = run(data)
    assert (r.rows_read, r.rows_late, r.watermark) == (3, 2, "2025-01-12 00:00:00.000000")
    assert run(data).status == "NO_DATA"
    data += [(6, day(12), "at the mark")]
    r = run(data)
    assert (r.rows_read, r.rows_late, r.status) == (1, 1, "SUCCEEDED")
    got = sorted((str(x.k), x.v) for x in spark.read.parquet(layout.bronze("t")).collect() if x.v)
    cut = (lambda v: v[:2]) if converted else (lambda v: v)
    assert got == sorted((str(k), cut(v)) for k, _, v in data if k not in (2, 4))
    assert run(data).status == "NO_DATA"


def test_lookback_over_numbers_and_dates(spark):
    from tidemark.sources.extract import late_rows
    for kind, lookback, mark in (("int", "3", "10"), ("date", "3 days", "2025-01-11")):
        col = F.col("id").cast("int") if kind == "int" else F.date_add(F.lit("2025-01-01").cast("date"), F.col("id").cast("int"))
        df = spark.range(20).select(col.alias("s"), "id")
        assert sorted(r.id for r in late_rows(df, df.where("id = 9"), "s", mark, lookback).collect()) == [8, 10]


def test_rejected_values_are_kept_and_counted(spark, layout):
    from pyspark.sql import types as T
    from tidemark.plans.ingest import read_rejects
    data = [(1, "12", "2025-01-01", 1.9), (2, "x", "never", 3e10), (3, None, None, None), (4, "13", "2025-01-02", -0.5)]
    src = spark.createDataFrame(data, "k int, a string, d string, f double").withColumn("s", F.lit("2025-01-01").cast("timestamp_ntz"))
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("a", T.IntegerType()), T.StructField("d", T.DateType()),
                           T.StructField("f", T.IntegerType()), T.StructField("extra", T.StringType())])
    r = ingest_table(spark, SourceTable("t", "s"), frame_reader({"t": src}), layout, target_schema=schema)
    assert dict(r.rejected) == {"a": 1, "d": 1, "f": 1} and r.rows_read == 4
    got = sorted((x.column_name, x.value, x.wanted) for x in read_rejects(spark, "t", layout).collect())
    assert got == [("a", "x", "int"), ("d", "never", "date"), ("f", "3.0E10", "int")]
    assert all('"k":2' in x.source_row for x in read_rejects(spark, "t", layout).collect())
    out = {x.k: (x.a, x.f) for x in spark.read.parquet(layout.bronze("t")).collect()}
    assert out == {1: (12, 1), 2: (None, None), 3: (None, None), 4: (13, 0)}
    assert read_rejects(spark, "other", layout).count() == 0

from tidemark.config import JoinSpec
from tidemark.operators.quality import (duplicate_keys, expect_all_or_drop, expectation_metrics,
                                        observe_rules)
from tidemark.operators.star import star_join

from conftest import rows

RULES = {"rule_1": "user_id IS NOT NULL", "pos": "amount > 0"}


def test_expect_all_or_drop_treats_null_as_violation(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (2, None), (3, -1)], "user_id int, amount int")
    assert rows(expect_all_or_drop(df, RULES)) == [(1, 5)]
    m = {r.rule: (r.failed_rows, r.total_rows) for r in expectation_metrics(df, RULES).collect()}
    assert m == {"rule_1": (1, 4), "pos": (2, 4)}


def test_observed_rule_counters(spark):
    from pyspark.sql import Observation
    df = spark.createDataFrame([(1, 5), (None, 5)], "user_id int, amount int")
    obs = Observation("dq")
    observe_rules(df, RULES, obs).collect()
    assert obs.get["failed_rule_1"] == 1 and obs.get["rows_out"] == 1


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert rows(duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]


def test_star_join_left_outer_with_duplicates_and_theta(spark):
    fact = spark.createDataFrame([(1, 10, 100), (2, 20, 200), (3, 99, 300)], "id int, k int, d int")
    dim = spark.createDataFrame([(10, "x"), (10, "x2"), (20, "y")], "k int, name string")
    rng = spark.createDataFrame([(0, 150, "small"), (150, 1000, "big")], "lo int, hi int, size string")
    tables = {"fact": fact, "dim": dim, "rng": rng}
    specs = [JoinSpec("fact", "f", ["f.id"]),
             JoinSpec("dim", "d", ["d.name"], "f.k = d.k"),
             JoinSpec("rng", "r", ["r.size"], "f.d >= r.lo AND f.d < r.hi", bounded=True)]
    out = rows(star_join(specs, tables.__getitem__))
    assert out == [(1, "x", "small"), (1, "x2", "small"), (2, "y", "big"), (3, None, "big")]

"""Data-quality expectations: drop violating rows and count them.

A rule is SQL boolean text. A row passes when every rule is TRUE; a rule
that evaluates to NULL counts as a violation (``coalesce(rule, false)``),
so ``user_id IS NOT NULL`` and ``amount > 0`` both drop NULL inputs.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def rule_column(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))


def all_rules(rules: Mapping[str, str]) -> Column:
    cond = F.lit(True)
    for r in rules.values():
        cond = cond & rule_column(r)
    return cond


def expect_all_or_drop(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Keep only rows that satisfy every rule."""
    return df.where(all_rules(rules)) if rules else df


def metric_columns(rules: Mapping[str, str]) -> list[Column]:
    cols = [F.count(F.lit(1)).alias("rows_in")]
    for name, r in rules.items():
        cols.append(F.count_if(~rule_column(r)).alias(f"failed_{name}"))
    cols.append(F.count_if(all_rules(rules)).alias("rows_out"))
    return cols


def observe_rules(df: DataFrame, rules: Mapping[str, str], name: str | Observation):
    """Attach rule counters to ``df`` (works on streams: the counts appear in
    ``StreamingQuery.lastProgress['observedMetrics'][name]``)."""
    return df.observe(name, *metric_columns(rules))


def expectation_metrics(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row per rule: ``rule, failed_rows, total_rows`` (distributed
    aggregate; only the rule count of rows reaches the result)."""
    agg = df.agg(*metric_columns(rules))
    per_rule = [F.struct(F.lit(n).alias("rule"), F.col(f"`failed_{n}`").alias("failed_rows")) for n in rules]
    kind = "array<struct<rule:string,failed_rows:bigint>>"
    return (agg.select(F.inline(F.array(*per_rule).cast(kind)), F.col("rows_in"))
            .withColumnRenamed("rows_in", "total_rows"))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Key uniqueness check: keys that occur more than once, with counts."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))

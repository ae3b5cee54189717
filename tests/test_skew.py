"""Hot keys, days and partitions: plans and results when one value holds a third of all rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import customfields, diff
from tidemark.operators.reconcile import SPECS, daily_amounts, daily_counts, reconcile
from tidemark.plans.staging import restrict_to_keys

N = 300_000


@pytest.fixture
def settings(spark):
    changed = {}

    def set_all(**conf):
        for key, value in conf.items():
            key = "spark.sql." + key.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """A third of the rows have key 0."""
    path = str(tmp_path_factory.mktemp("hot") / "t")
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    rows = spark.range(N, numPartitions=8).select(key.alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    rows.write.parquet(path)
    return spark.read.parquet(path)


SMALL = dict(
    autoBroadcastJoinThreshold="-1",
    adaptive__autoBroadcastJoinThreshold="-1",
    adaptive__skewJoin__skewedPartitionThresholdInBytes="200000",
    adaptive__skewJoin__skewedPartitionFactor="1.5",
    adaptive__advisoryPartitionSizeInBytes="200000",
)


def final_plan(df):
    """Rows, and the plan that produced them with its skew splits."""
    rows = df.collect()
    return len(rows), df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("null_safe", [False, True])
def test_shuffled_restriction_splits_the_hot_key(hot, settings, null_safe):
    settings(**SMALL)
    wanted = hot.select("k").filter("k % 2 = 0")
    rows, plan = final_plan(restrict_to_keys(hot, wanted, ["k"], null_safe))
    assert rows == hot.filter("k % 2 = 0").count()
    assert "SortMergeJoin(skew=true)" in plan


def test_overlay_splits_the_hot_key(hot, settings):
    settings(**SMALL)
    fixes = hot.select("k", F.lit("fixed").alias("pad")).filter("k <> 0")
    primary = hot.withColumn("pad", F.when(F.col("v") % 2 == 0, F.col("pad")))
    rows, plan = final_plan(customfields.overlay(primary, fixes, ["pad"], "k"))
    assert rows == N
    assert "SortMergeJoin(skew=true)" in plan


def test_comparison_shuffles_each_key_of_a_task_once(spark, hot):
    compared = diff.compare_keys(hot, hot.filter("k <> 0"), ["k"])
    assert {r.provenance: r["count"] for r in compared.groupBy("provenance").count().collect()} == {
        "left_only": 1,
        "both": hot.filter("k <> 0").count(),
    }
    plan = compared._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "pad" not in plan


def test_hot_day_is_spread_by_key(spark, hot):
    day = F.lit(date(2024, 1, 15))
    counts = daily_counts(hot, day, "k")
    assert tuple(counts.first()) == (date(2024, 1, 15), N, hot.select("k").distinct().count())
    plan = counts._jdf.queryExecution().executedPlan().toString()
    first = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line][-1]
    assert "k#" in first


def test_hot_day_amounts_shuffle_groups_only(spark, hot):
    df = hot.select(
        F.col("v").alias("id"), F.lit("GBP").alias("currency_code"), F.lit("D").alias("type"), F.lit("1.01").alias("amount")
    )
    row = daily_amounts(df, F.lit(date(2024, 1, 15))).first()
    assert (row.total_rowcount_for_date, str(row.sum_amount_for_currency_and_date)) == (N, f"{N * 1.01:.2f}")
    plan = daily_amounts(df, F.lit(date(2024, 1, 15)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_reconciliation_joins_grouped_rows_only(spark, hot):
    df = hot.select(F.col("k").alias("id"), F.lit(datetime(2024, 1, 15)).alias("creation_date"))
    row = reconcile(SPECS["deposit_accounts"], df, df.filter("id <> 0")).first()
    assert (row.source_total_rowcount_for_date, row.target_total_rowcount_for_date) == (N, N - N // 3)
    assert row.source_total_deposit_accounts_for_date - row.target_total_deposit_accounts_for_date == 1

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import diff, repair
from tidemark.operators.reconcile import (
    SPECS,
    check_counts,
    reconcile,
    reconcile_outcome,
    result_catalog,
)
from tidemark.plans import ingest
from tidemark.sinks import tables

RUN = datetime(2024, 1, 16, 3, 0)
DAY = date(2024, 1, 15)


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "k int")


def test_compare_keys(spark, rows):
    compared = diff.compare_keys(keys(spark, 1, 1, 2, None), keys(spark, 2, 3, 3, None), ["k"])
    assert rows(compared) == [(1, "left_only"), (2, "both"), (3, "right_only"), (None, "both")]


def test_keys_are_shuffled_once_and_only_keys(spark):
    df = spark.range(100).select(F.col("id").alias("k"), F.lit("wide").alias("w"))
    plan = diff.compare_keys(df, df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan and "wide" not in plan


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(*[st.lists(st.none() | st.integers(0, 6), max_size=12)] * 2)
def test_three_way_split_is_a_partition(spark, left, right):
    got = {r.k: r.provenance for r in diff.compare_keys(keys(spark, *left), keys(spark, *right), ["k"]).collect()}
    wanted = {k: "both" if k in left and k in right else "left_only" if k in left else "right_only" for k in {*left, *right}}
    assert got == wanted


def test_missing_rows_keep_repeats_and_null_keys(spark, rows):
    source = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    assert rows(diff.missing_rows(source, keys(spark, 2, 5), ["k"]), "v") == [("a",), ("b",), ("d",)]
    assert rows(diff.missing_rows(source, keys(spark, 1, None), ["k"]), "v") == [("c",)]


def test_a_hot_key_is_neither_lost_nor_gathered(spark):
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    target = hot.filter("k <> -1")
    missing = diff.missing_rows(hot, target, ["k"])
    assert missing.count() == 10_000
    # Few missing keys: the wide side is filtered where it is read.
    assert "Exchange hashpartitioning" not in missing._jdf.queryExecution().executedPlan().toString()


def test_many_missing_keys_use_a_shuffled_join(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        source = spark.range(2000).withColumnRenamed("id", "k").withColumn("v", F.lit(1))
        missing = diff.missing_rows(source, source.filter("k < 500"), ["k"])
        plan = missing._jdf.queryExecution().executedPlan().toString()
        assert missing.count() == 1500
        assert "SortMergeJoin" in plan and "Broadcast" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_several_keys_match_nulls(spark, rows):
    schema = "id int, state string, at timestamp"
    source = spark.createDataFrame([(1, None, datetime(2024, 1, 1)), (2, "A", datetime(2024, 1, 1))], schema)
    lake = spark.createDataFrame([(1, None, datetime(2024, 1, 1)), (2, "B", datetime(2024, 1, 1))], schema)
    text = source.withColumn("at", F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    missing = diff.missing_versions(text, lake, ["id", "state", "at"], {"at": F.to_timestamp("at")})
    assert rows(missing, "id") == [(2,)]


def stream_rows(spark, spec, *entries):
    """(day, key, currency, type, amount) rows with the columns a stream is compared by."""
    df = spark.createDataFrame(list(entries), "at string, key string, currency_code string, type string, amount string")
    for column in {spec.day or "at", spec.target_day or "at"} - {"at"}:
        df = df.withColumn(column, F.col("at").cast("timestamp"))
    return df.withColumn(spec.key, F.col("key"))


@pytest.mark.parametrize("name", sorted(SPECS))
def test_every_stream_reconciles(spark, name):
    spec = SPECS[name]
    source = stream_rows(spark, spec, ("2024-01-15 01:00:00", "1", "GBP", "D", "1.10"), ("2024-01-15 02:00:00", "1", "GBP", "D", "2.20"), ("2024-01-15 03:00:00", "9", "EUR", "D", "3"))
    target = stream_rows(spark, spec, ("2024-01-15 01:00:00", "1", "GBP", "D", "1.10"), ("2024-01-14 01:00:00", "3", "GBP", "D", "5"))
    recon = reconcile(spec, source, target, RUN.date(), RUN)
    stored = recon.select(*[F.col(c).cast(k).alias(c) for c, k in result_catalog(spec).types.items()])
    (row,) = stored.collect()
    assert row.reconciliation_date == DAY and row.timestamp_extracted == RUN
    assert (row.source_total_rowcount_for_date, row.target_total_rowcount_for_date) == (3, 1)
    if spec.by_amount:
        assert (row.source_min_id_for_date, row.source_max_id_for_date, row.currency_code) == (1, 9, "GBP")
        assert (str(row.source_sum_amount_for_currency_and_date), row.source_currency_type_transactions_total_for_date) == ("3.30", 2)
    else:
        assert (row[f"source_total_{spec.label}_for_date"], row[f"target_total_{spec.label}_for_date"]) == (2, 1)
    assert [r.status for r in check_counts(recon, spec).collect()] == [-1] * len(spec.check)
    assert reconcile_outcome(spec, recon, 1) == "mismatch"
    assert reconcile_outcome(spec, reconcile(spec, source, source, RUN.date()), 1) == "match"
    assert reconcile_outcome(spec, recon.limit(0), 0) == "no_target_rows"


def test_days_only_one_side_has(spark, rows):
    spec = SPECS["users"]
    source = stream_rows(spark, spec, ("2024-01-15", "1", "", "", ""), ("2024-01-16", "2", "", "", ""), (None, "3", "", "", ""))
    target = stream_rows(spark, spec, ("2024-01-15", "1", "", "", ""), ("2024-01-17", "2", "", "", ""))
    count = lambda how: reconcile(spec, source, target, how=how).count()
    assert (count("inner"), count("left"), count("full")) == (1, 2, 3)
    status = check_counts(reconcile(spec, source, target, how="full"), spec)
    assert rows(status, "reconciliation_date", "status") == [(date(2024, 1, 15), 0), (date(2024, 1, 16), -1), (date(2024, 1, 17), -1)]
    assert rows(check_counts(reconcile(spec, source, target, how="left"), spec, first_only=True), "status") == [(0,)]


def test_null_keys_are_not_counted(spark):
    spec = SPECS["clients"]
    source = stream_rows(spark, spec, ("2024-01-15", None, "", "", ""), ("2024-01-15", "1", "", "", ""))
    row = reconcile(spec, source, source).first()
    assert (row.source_total_rowcount_for_date, row.source_total_clients_for_date) == (2, 1)


def test_null_currency_counts_for_the_day_only(spark):
    spec = SPECS["deposit_transactions"]
    source = stream_rows(spark, spec, ("2024-01-15", "1", None, "D", "1"), ("2024-01-15", "2", "GBP", "D", "1"))
    (row,) = reconcile(spec, source, source).collect()
    assert (row.currency_code, row.source_total_rowcount_for_date, row.source_currency_type_transactions_total_for_date) == ("GBP", 2, 1)


def test_run_day_filter_reaches_the_scan(spark, tmp_path):
    spec = SPECS["users"]
    stream_rows(spark, spec, ("2024-01-15", "1", "", "", "")).write.parquet(str(tmp_path / "u"))
    df = spark.read.parquet(str(tmp_path / "u"))
    plan = reconcile(spec, df, df, RUN.date())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(last_modified_date") == 2 and "amount" not in plan


def lake_of(spark, path):
    return lambda: spark.read.option("mergeSchema", "true").parquet(path)


def test_late_rows_are_repaired(spark, tmp_path, rows):
    spec, path = SPECS["deposit_transactions"], str(tmp_path / "lake")
    schema = "id string, creation_date string, amount string, currency_code string, type string"
    entries = [("1", "2024-01-15 05:00:00", "1", "GBP", "D"), ("2", "2024-01-15 06:00:00", "2", "GBP", "D"), ("3", "2024-01-10 06:00:00", "3", "GBP", "D")]
    source = spark.createDataFrame(entries, schema)
    tables.append(source.filter("id = '1'").withColumn("date", F.lit("20240115")), path)
    first, late = repair.repair_and_reconcile(spec, source, lake_of(spark, path), RUN)
    assert first.first().target_total_rowcount_for_date == 1
    # A dry run; the row of an earlier day is not looked at.
    assert rows(late, "id", "creation_date", "date") == [("2", "2024-01-15T06:00:00.000000Z", "20240116")]
    final, late = repair.repair_and_reconcile(spec, source, lake_of(spark, path), RUN, lambda df: tables.append(df, path))
    assert final.first().target_total_rowcount_for_date == 2
    again, late = repair.repair_and_reconcile(spec, source, lake_of(spark, path), RUN)
    assert late is None


def test_mismatch_without_missing_ids_repairs_nothing(spark, tmp_path):
    spec, path = SPECS["deposit_transactions"], str(tmp_path / "lake")
    schema = "id string, creation_date string, amount string, currency_code string, type string"
    source = spark.createDataFrame([("1", "2024-01-15 05:00:00", "1", "GBP", "D")], schema)
    tables.append(source.unionByName(source).withColumn("date", F.lit("20240115")), path)
    recon, late = repair.repair_and_reconcile(spec, source, lake_of(spark, path), RUN)
    assert recon.first().target_total_rowcount_for_date == 2 and late is None


def test_backfill_dry_run_apply_dry_run(spark, tmp_path, rows):
    path, reports = str(tmp_path / "lake"), str(tmp_path / "reports")
    tables.append(spark.createDataFrame([("1", "20240101"), ("9", "20240101")], "k string, date string"), path)
    source = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    dry = ingest.three_way_backfill(source, path, "k", RUN, reports=reports)
    assert rows(dry.not_in_lake) == [("2",)] and rows(dry.not_in_source) == [("9",)] and rows(dry.in_both) == [("1",)]
    assert rows(dry.to_backfill) == [("2", "b"), ("2", "c")]
    assert spark.read.option("header", "true").csv(f"{reports}/source").count() == 3
    assert rows(spark.read.option("header", "true").csv(f"{reports}/not_in_data_lake")) == [("2",)]
    ingest.three_way_backfill(source, path, "k", RUN, apply=True)
    again = ingest.three_way_backfill(source, path, "k", RUN)
    assert again.to_backfill.isEmpty() and again.not_in_lake.isEmpty()
    assert spark.read.parquet(path).filter("date = '20240116'").count() == 2

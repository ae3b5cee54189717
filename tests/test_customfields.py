from pyspark.sql import functions as F

from tidemark.operators import customfields as cf


def slots(spark, *entries):
    """(id, f0, v0, f1, v1) rows."""
    return spark.createDataFrame(
        list(entries),
        "id string, custom_fields_0_id string, custom_fields_0_value string, custom_fields_1_id string, custom_fields_1_value string",
    )


def test_pivot_with_fillers(spark):
    df = slots(spark, ("1", "a", "x", "b", None), ("2", "a", "x", "a", "later"), ("3", None, None, None, None), ("4", "<NA>", "y", "c", "z"))
    out = {r.id: r.asDict() for r in cf.pivot_custom_fields(df, run_date="20240101").collect()}
    assert out["1"] == {"id": "1", "a": "x", "b": "0", "c": "None", "<NA>": "None", "date": "20240101"}
    assert out["2"]["a"] == "later"
    assert (out["3"]["a"], out["3"]["b"]) == ("None", "None")
    assert out["4"]["c"] == "z"


def test_pivot_with_nulls_and_given_ids(spark):
    df = slots(spark, ("1", "a", "x", "b", None))
    out = cf.pivot_custom_fields(df, ["b", "zz", "0"], fill=False)
    assert [r.asDict() for r in out.collect()] == [{"id": "1", "b": None, "zz": None}]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_pivot_covers_all_ids_present_not_only_the_filtered(spark):
    df = slots(spark, ("1", "a", "x", "other", "y"), ("2", "none", "x", None, None)).filter(cf.any_slot_in(["a"], 2))
    assert cf.pivot_custom_fields(df).columns == ["id", "a", "other"]


def test_any_slot(spark, rows):
    df = slots(spark, ("1", "a", "", None, ""), ("2", None, "", "a", ""), ("3", "b", "", "c", ""), ("4", None, "", None, ""))
    assert rows(df.filter(cf.any_slot_in(["a", "z"], 2)), "id") == [("1",), ("2",)]
    assert rows(cf.field_ids(df)) == [("a",), ("b",), ("c",)]


def test_channels(spark, rows):
    entries = [("1", "Wise_Local_Payments", "f"), ("2", "Card_x", "f"), ("3", "Paymentology-FastLite", "f"), ("4", "Other", "f"), ("5", None, "f"), ("6", "Card_x", ""), ("7", "Card_x", None)]
    df = spark.createDataFrame(entries, f"id string, {cf.CHANNEL_COLUMN} string, custom_fields_0_id string")
    assert rows(df.filter(cf.channel_filter()), "id") == [("1",), ("2",), ("3",)]
    assert rows(df.filter(cf.channel_filter(names=["Wise_Local_Payments"])), "id") == [("1",), ("2",)]


def test_projection_has_nineteen_columns(spark):
    fields = [f"custom_fields_{i}_{p} string" for i in range(5) for p in ("id", "field_set_id", "value")]
    df = spark.createDataFrame([], f"id string, encoded_key string, {', '.join(fields)}, date string, timestamp_extracted timestamp, more int")
    assert len(cf.slot_projection(df).columns) == 19 and "more" not in cf.slot_projection(df).columns


def test_overlay(spark, rows):
    primary = spark.createDataFrame([("1", None, "x"), ("2", "own", None), ("3", None, None), (None, None, None)], "id string, a string, b string")
    fixes = spark.createDataFrame([("1", "fix", "fix"), ("2", "fix", "fix"), ("2", "fix", "two"), (None, "no", "no")], "id string, a string, b string")
    assert rows(cf.overlay(primary, fixes, ["a"])) == [("1", "fix", "x"), ("2", "own", None), ("2", "own", None), ("3", None, None), (None, None, None)]
    unique = fixes.dropDuplicates(["id"])
    assert cf.overlay(primary, unique, ["a", "b"]).count() == primary.count()


def test_slot_extremes_are_in_text_order(spark):
    df = slots(spark, ("9", "a", "", "b", ""), ("10", "a", "", "b", ""), ("5", "a", "", None, "")).withColumn("timestamp_extracted", F.lit("t"))
    got = {(r.custom_fields_0_id, r.custom_fields_1_id): (r.min_id, r.max_id) for r in cf.slot_extremes(df, 2).collect()}
    assert got == {("a", "b"): ("10", "9"), ("a", None): ("5", "5")}

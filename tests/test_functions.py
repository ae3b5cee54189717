from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import coerce, naming, text, timestamps


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "written, instant",
    [
        ("2024-07-30T18:27:00+03:00", datetime(2024, 7, 30, 15, 27)),
        ("2024-07-30T18:27:00Z", datetime(2024, 7, 30, 18, 27)),
        ("2024-07-30T18:27:00.123456Z", datetime(2024, 7, 30, 18, 27, 0, 123456)),
        ("2024-07-30", datetime(2024, 7, 30)),
        ("2024-07-30 18:27:00", datetime(2024, 7, 30, 18, 27)),
        ("2024-7-3 8:07:00", datetime(2024, 7, 3, 8, 7)),
        ("7/30/2024 6:27:00 PM", datetime(2024, 7, 30, 18, 27)),
        ("07/30/2024 12:05:00 am", datetime(2024, 7, 30, 0, 5)),
        ("30-07-2024 18:27:00", datetime(2024, 7, 30, 18, 27)),
        ("2025-14-04 22:19:21", datetime(2025, 4, 14, 22, 19, 21)),
        # Day and month are only swapped where the month position cannot be a month.
        ("2025-04-05 22:19:21", datetime(2025, 4, 5, 22, 19, 21)),
        ("", None),
        (None, None),
    ],
)
def test_timestamp_layouts(spark, written, instant):
    assert one(spark, written, timestamps.parse_timestamp) == instant


def test_unreadable_timestamp_is_an_error_naming_value_and_column(spark):
    with pytest.raises(Exception, match="(?s)junk.*birth"):
        one(spark, "junk", lambda c: timestamps.parse_timestamp(c, "birth"))
    assert one(spark, "junk", timestamps.try_parse_timestamp) is None


def test_bookmark_second_keeps_layout(spark):
    assert one(spark, "2020-01-01T00:00:59Z", timestamps.add_second_text) == "2020-01-01T00:01:00Z"
    assert one(spark, "2020-01-01T00:00:00.000000Z", timestamps.add_second_text) == "2020-01-01T00:00:01.000000Z"


@pytest.mark.parametrize("kind, value", [("string", "2024-01-15T23:59:59Z"), ("timestamp", datetime(2024, 1, 15, 23, 59, 59)), ("date", date(2024, 1, 15))])
def test_on_day_for_each_type(spark, kind, value):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    assert df.filter(timestamps.on_day(df, "x", date(2024, 1, 15))).count() == 1
    assert df.filter(timestamps.on_day(df, "x", date(2024, 1, 16))).count() == 0


def test_extraction_time_is_not_parsed(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z", "kept")], "seen string, timestamp_extracted string")
    parsed = timestamps.parse_catalogued(df, {"seen": "timestamp", "timestamp_extracted": "timestamp"})
    assert parsed.dtypes == [("seen", "timestamp"), ("timestamp_extracted", "string")]


@pytest.mark.parametrize(
    "value, whole, double",
    [("1", 1, 1.0), ("2.5", 2, 2.5), (" 7 ", 7, 7.0), ("x", 0, 0.0), (None, 0, 0.0), ("", 0, 0.0), ("1d", 0, 0.0), ("nan", 0, 0.0), ("1e3", 1000, 1000.0), ("9007199254740993", 9007199254740993, 9007199254740992.0), ("99999999999999999999", 0, 1e20)],
)
def test_numbers_coerce(spark, value, whole, double):
    assert one(spark, value, coerce.to_whole) == whole
    assert one(spark, value, coerce.to_double) == double


def test_numbers_can_stay_null(spark):
    assert one(spark, "x", lambda c: coerce.to_double(c, False)) is None
    assert one(spark, "x", lambda c: coerce.to_whole(c, "int", False)) is None


@pytest.mark.parametrize("value, read, truth", [("true", True, True), ("False", False, True), ("", None, False), (None, None, False)])
def test_booleans(spark, value, read, truth):
    assert one(spark, value, coerce.to_boolean) is read
    assert one(spark, value, coerce.truthy) is truth


@pytest.mark.parametrize(
    "name, words, letters",
    [
        ("encodedKey", "encoded_key", "encoded_key"),
        ("_CC_contactId", "cc_contact_id", "c_c_contact_id"),
        ("CC_AccNoOrIBAN", "cc_acc_no_or_iban", "c_c__acc_no_or_i_b_a_n"),
        ("accountHolderIBAN", "account_holder_iban", "account_holder_i_b_a_n"),
        ("IBANCode", "iban_code", "i_b_a_n_code"),
        ("a__b_", "a_b", "a__b_"),
    ],
)
def test_snake_case(spark, name, words, letters):
    assert naming.snake_words(name) == words == one(spark, name, naming.snake_words_column)
    assert naming.snake_letters(name) == letters == one(spark, name, naming.snake_letters_column)


def test_renamed_names_must_differ(spark):
    with pytest.raises(ValueError, match="a_b"):
        naming.snake_case(spark.createDataFrame([(1, 2)], ["aB", "a_b"]))


def test_renames_apply_in_order(spark):
    df = naming.rename_in_order(spark.createDataFrame([(1, 2)], ["a", "b"]), [{"a": "c"}, {"c": "d", "x": "y"}])
    assert df.columns == ["d", "b"]


@pytest.mark.parametrize("dirty, clean", [("a\n\rb\tc", "a b c"), ("a  b", "a b"), ("a   b", "a  b"), ("a    b", "a  b"), (None, None)])
def test_clean_text(spark, dirty, clean):
    assert one(spark, dirty, text.clean_text) == clean


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \n\t\r", max_size=12), min_size=1, max_size=20))
def test_clean_text_is_one_pass(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = {r.i: r.y for r in df.select("i", text.clean_text("x").alias("y")).collect()}
    for i, value in enumerate(values):
        for mark in "\n\r\t":
            value = value.replace(mark, " ")
        assert got[i] == value.replace("  ", " ")


def test_fill_missing(spark, rows):
    df = spark.createDataFrame([(None, "<NA>", 3)], "a string, b string, c int")
    assert rows(text.fill_missing(df)) == [("0", "0", "3")]


def test_clean_json_after_any_number_of_backslashes(spark):
    from tidemark.functions.text import clean_json

    rows = [(n, "x" + "\\" * n + "ny") for n in range(81)]
    found = spark.createDataFrame(rows, "n int, t string").select("n", clean_json(F.col("t")).alias("t")).collect()
    assert all(r.t == ("x" + "\\" * (r.n - 1) + " y" if r.n % 2 else "x" + "\\" * r.n + "ny") for r in found)


def test_clean_json_splits_a_text_once(spark):
    """Not once more for each of its parts: a record of many strings is read in one pass."""
    import json

    from tidemark.functions.text import clean_json

    record = {f"a  {i}": f"x  {i}\n\ty" for i in range(2000)}
    df = spark.createDataFrame([(json.dumps(record),), (None,), ("a  b",)], "t string").select(clean_json(F.col("t")).alias("t"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    kept, missing, bare = (r.t for r in df.collect())
    assert json.loads(kept) == {k: v.replace("  ", " ").replace("\n\t", " ") for k, v in record.items()} and missing is None and bare == "a b"


def test_chunks_keep_fractions_of_a_second(spark):
    from datetime import datetime

    from tidemark.operators.chunks import plan_chunks

    plan = plan_chunks(spark, datetime(2024, 1, 1), datetime(2024, 1, 2, 0, 0, 0, 500_000)).orderBy("chunk_num").collect()
    assert [(str(r.start_date), str(r.end_date)) for r in plan] == [
        ("2024-01-01 00:00:00", "2024-01-02 00:00:00"), ("2024-01-02 00:00:00", "2024-01-02 00:00:00.500000")
    ]


def test_append_refuses_a_stream_sink(spark, tmp_path):
    import pytest

    from tidemark.sinks import tables

    (tmp_path / "_spark_metadata").mkdir()
    with pytest.raises(ValueError, match="stream"):
        tables.append(spark.range(1).selectExpr("id", "'20240101' AS date"), str(tmp_path))

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators.shape import add_meta, drop_null_columns, leftovers_as_text, record_table
from tidemark.operators.typing import apply_types, boolean_or_text, infer_types
from tidemark.plans import catalog
from tidemark.functions.naming import snake_letters

NOW = datetime(2024, 2, 1, 1, 0, 0, 5)


def inferred(spark, *values, name="x"):
    return infer_types(spark.createDataFrame([(v,) for v in values], f"{name} string"))[name]


@pytest.mark.parametrize(
    "values, kind",
    [
        (("1", "-2", None, "", "None"), "int"),
        (("1", "2147483648"), "bigint"),
        (("1", "-2147483649"), "bigint"),
        (("1", "99999999999999999999"), "string"),
        (("1", "2.5"), "double"),
        (("1e5",), "double"),
        (("007", "1"), "string"),
        (("true", "False"), "boolean"),
        (("true", "1"), "string"),
        (("2024-01-01", "2024-01-02"), "date"),
        (("2024-01-01", "2024-01-02T03:00:00Z"), "timestamp"),
        (("7/30/2024 6:27:00 PM",), "timestamp"),
        (("2024-01-01", "x"), "string"),
        (("2024-01-01", "5"), "string"),
        (("[1]",), "string"),
        ((None, ""), "string"),
    ],
)
def test_inference(spark, values, kind):
    assert inferred(spark, *values) == kind


def test_the_date_column_stays_text(spark):
    assert inferred(spark, "20240101", name="date") == "string"
    assert inferred(spark, "2024-01-01", name="date") == "string"


def test_apply_types(spark):
    df = spark.createDataFrame([("x", None, "false", "2024-01-02T03:04:05Z", "", "20240101", "k")], "i string, d string, b string, ts string, day string, date string, rest string")
    kinds = {"i": "int", "d": "double", "b": "boolean", "ts": "timestamp", "day": "date", "date": "string", "absent": "int"}
    out = apply_types(df, kinds)
    assert out.dtypes == [("i", "int"), ("d", "double"), ("b", "boolean"), ("ts", "timestamp"), ("day", "date"), ("date", "string"), ("rest", "string")]
    assert tuple(out.first()) == (0, 0.0, False, datetime(2024, 1, 2, 3, 4, 5), None, "20240101", "k")
    kept = apply_types(df, kinds, null_as_zero=False, truthy_booleans=True).first()
    assert (kept.i, kept.d, kept.b) == (None, None, True)


def test_bad_timestamp_stops_or_not(spark):
    df = spark.createDataFrame([("junk",)], "ts string")
    with pytest.raises(Exception, match="junk in ts"):
        apply_types(df, {"ts": "timestamp"}).collect()
    assert apply_types(df, {"ts": "timestamp"}, strict_timestamps=False).first().ts is None


def test_boolean_or_text(spark):
    df = spark.createDataFrame([("true", "x", "true"), ("false", "true", None)], "access_a string, access_b string, other string")
    assert boolean_or_text(df, {}).dtypes == [("access_a", "boolean"), ("access_b", "string"), ("other", "string")]
    assert boolean_or_text(df, {"other": "boolean"}).dtypes[2] == ("other", "boolean")


def test_meta_columns(spark):
    df = spark.createDataFrame([("2024-01-15 10:00:00",)], "changed string")
    by_change = add_meta(df, NOW, "changed").first()
    assert (by_change.date, by_change.changed, by_change.timestamp_extracted) == ("20240115", datetime(2024, 1, 15, 10), NOW)
    assert add_meta(df, NOW).first().date == "20240201"


def test_nested_columns_become_text(spark):
    df = spark.sql("SELECT struct(1 AS a) AS s, array(1, 2) AS l, 5 AS n")
    assert tuple(record_table(df, NOW, flat=False).first())[:3] == ('{"a":1}', "[1,2]", 5)
    out, types = leftovers_as_text(df, {"l": "string"})
    assert types == {"l": "string", "s": "string"}
    assert out.first().s == '{"a":1}'


def test_null_columns_are_dropped(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x")], "a int, b string, c string")
    assert drop_null_columns(df).columns == ["a", "c"]


@pytest.mark.parametrize(
    "name, kind",
    [
        ("birth_date", "date"), ("creation_date", "timestamp"), ("date", "timestamp"), ("amount", "double"),
        ("balances_total_balance", "double"), ("custom_fields_3_value", "string"), ("loan_cycle", "int"),
        ("access_api_access", "boolean"), ("overdraft_settings_allow_overdraft", "boolean"), ("first_name", "string"),
        ("access_permissions_12", "string"),
    ],
)
def test_type_rules(name, kind):
    assert catalog.type_of(name) == kind


def test_catalog_forms(spark, tmp_path):
    ddl = catalog.from_ddl("id string COMMENT 'the key', amount decimal(20,2)")
    assert ddl.types == {"id": "string", "amount": "decimal(20,2)"} and ddl.comments == {"id": "the key"}
    assert catalog.from_schema(ddl.schema()) == ddl
    assert ddl.schema()["id"].metadata == {"comment": "the key"}
    path = tmp_path / "catalog.json"
    path.write_text('{"schemas": {"t": {"loanAmount": "double"}}, "column_comments": {"t": {"loanAmount": "sum lent"}}}')
    (read,) = catalog.read_catalogs(spark, str(path)).values()
    assert read.renamed(snake_letters) == catalog.TableCatalog({"loan_amount": "double"}, {"loan_amount": "sum lent"})
    assert catalog.from_names(["a_date", "b"], {"b": "int"}).types == {"a_date": "timestamp", "b": "int"}
    kinds = catalog.installments().types
    assert len(kinds) == 33 and kinds["fee_tax_due"] == "double" and "principal_tax_due" not in kinds
    assert list(catalog.slot_catalog(["f"]).types) == ["id", "encoded_key", "creation_date", "f", "date"]


def test_columns_of_a_batch_keep_comments(spark):
    df = catalog.with_comments(spark.range(1), {"id": "row"})
    assert df.schema["id"].metadata == {"comment": "row"}
    assert df.select(F.col("id")).first().id == 0


def test_date_values_pass_through(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),)], "d date")
    assert apply_types(df, {"d": "timestamp"}).first().d == datetime(2024, 1, 1)

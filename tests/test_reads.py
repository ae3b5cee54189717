from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.sources import landed, pages, reads


def paged(spark, **sizes):
    rows = [(int(page[1:]), i) for page, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "page int, i int")


@pytest.mark.parametrize(
    "sizes, last, kept",
    [
        (dict(p0=3, p1=3, p2=2), 2, 8),
        (dict(p0=3, p1=2, p2=3), 1, 5),
        (dict(p0=3, p1=3), 2, 6),
        (dict(p0=3, p2=3), 1, 3),
        (dict(p1=3, p2=1), 0, 0),
        (dict(p0=1), 0, 1),
    ],
)
def test_a_page_set_ends_with_the_first_short_or_missing_page(spark, sizes, last, kept):
    df = paged(spark, **sizes)
    assert pages.last_page(df, limit=3).first().last_page == last
    assert pages.complete_pages(df, limit=3).count() == kept


def test_page_slices_agree(spark):
    df = spark.range(1000).select((F.lit(999) - F.col("id")).alias("id"))
    near = [r.id for r in pages.page_slice(df, ["id"], 250, 100).collect()]
    deep = [r.id for r in pages.page_slice(df, ["id"], 250, 100, near=10).collect()]
    assert near == deep == list(range(250, 350))


def test_page_slices_of_tied_rows_give_each_row_once(spark):
    rows = [(i, i % 3) for i in range(120)]
    found = []
    for n, offset in enumerate(range(0, 120, 40)):
        df = spark.createDataFrame(rows[::-1] if n % 2 else rows, "id int, tied int").repartition(n + 2)
        found += [r.id for r in pages.page_slice(df, ["tied"], offset + 10, 40).collect()]
    assert len(found) == len(set(found)) == 110


def test_row_numbers_follow_the_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k")).withColumn("pad", F.lit("x"))
    got = [(r.k, r.row_number) for r in pages.number_rows(df, "k").collect()]
    assert sorted(got) == [(k, i) for i, k in enumerate(sorted(k for k, _ in got))]


def changes(spark):
    return spark.createDataFrame([(i, datetime(2024, 1, 1, i)) for i in range(5)], "id int, at timestamp")


def test_cdc_range_includes_both_ends(spark):
    df = changes(spark)
    start, end = datetime(2024, 1, 1, 1), "2024-01-01T03:00:00+00:00"
    assert [r.id for r in reads.cdc_range(df, "at", start, end).collect()] == [1, 2, 3]
    assert [r.id for r in reads.cdc_range(df, "at", start, end, half_open=True).collect()] == [1, 2]


def test_cdc_range_of_text_compares_instants(spark, tmp_path):
    texts = ["2024-01-20T10:00:00Z", "2024-01-05T03:00:00Z", "2024-01-05T06:00:00.000Z", "2024-01-20T23:30:00+06:00", "2024-01-20T18:00:00.5Z", "2024-01-20 18:00:00", "junk", None]
    spark.createDataFrame(list(enumerate(texts)), "id int, at string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for start, end in [(datetime(2024, 1, 5, 6), datetime(2024, 1, 20, 18)), ("2024-01-05T06:00:00+00:00", "2024-01-20T18:00:00Z")]:
        assert [r.id for r in reads.cdc_range(df, "at", start, end).collect()] == [2, 0, 3, 5]
        assert [r.id for r in reads.cdc_range(df, "at", start, end, half_open=True, iso_text=True).collect()] == [2, 0, 3]
    plan = reads.cdc_range(df, "at", start, end, iso_text=True)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at,2024-01-03)" in plan and "LessThan(at,2024-01-23)" in plan


def test_cdc_range_reaches_the_scan(spark, tmp_path):
    changes(spark).write.parquet(str(tmp_path / "c"))
    df = reads.cdc_range(spark.read.parquet(str(tmp_path / "c")), "at", "2024-01-01", "2024-01-02", ordered=False)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at" in plan and "LessThanOrEqual(at" in plan and "Exchange" not in plan


def test_dispatch(spark):
    df = changes(spark)
    assert reads.read_stream(df, "users", "get").count() == 5
    assert reads.read_stream(df, "clients:search", "post", cdc="at", start="2024-01-01", end="2024-01-01 01:00:00").count() == 2
    with pytest.raises(ValueError, match="change field"):
        reads.read_stream(df, "clients:search", "post")
    with pytest.raises(ValueError, match="neither get nor post"):
        reads.read_stream(df, "clients", "put")


def test_unsorted_endpoint(spark):
    def ordered(endpoint):
        df = reads.read_stream(changes(spark), endpoint, "post", cdc="at", start="2024-01-01", end="2024-01-02")
        return "Sort" in df._jdf.queryExecution().optimizedPlan().toString()

    assert ordered("clients:search") and not ordered("creditarrangements:search")


def test_ledger_and_installment_categories(spark, rows):
    accounts = spark.createDataFrame([("ASSET",), ("OTHER",), (None,)], "type string")
    assert rows(reads.read_stream(accounts, "glaccounts", "get", end="2024-02-01T00:00:00+00:00")) == [("ASSET", date(2024, 1, 31))]
    due = spark.createDataFrame([("ACTIVE", date(2023, 1, 1)), ("ACTIVE", date(2021, 1, 1)), ("GONE", date(2023, 1, 1))], "account_state string, due_date date")
    assert reads.read_stream(due, "installments", "get").count() == 1


def test_union_fills_missing_columns(spark, rows):
    frames = [spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2,)], "b int")]
    assert rows(reads.union_all(frames)) == [(1, None), (None, 2)]


def test_json_lines(spark, tmp_path):
    assert landed.read_json_lines(spark, str(tmp_path), "clients") is None
    (tmp_path / "clients-1.jsonl").write_text('{"a":1}\n\n{"a":2}\n')
    (tmp_path / "clients-2.jsonl").write_text('{"a":3}\n')
    (tmp_path / "other-1.jsonl").write_text('{"a":4}\n')
    assert landed.read_json_lines(spark, str(tmp_path), "clients").count() == 3


def test_tables_by_name_and_path(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).write.parquet(path)
    spark.range(2).selectExpr("id", "'x' AS more").write.mode("append").parquet(path)
    assert sorted(reads.read_table(spark, path).columns) == ["id", "more"]
    wide = spark.range(0).selectExpr("id", "CAST(NULL AS string) AS more").schema
    assert reads.read_table(spark, path, wide).filter("more IS NULL").count() == 2
    spark.range(3).createOrReplaceTempView("named")
    assert reads.read_table(spark, "named").count() == 3


def test_rows_with_given_values(spark, rows):
    assert rows(reads.rows_with(spark.range(5), "id", [1, 3, 9])) == [(1,), (3,)]


def test_sql_with_parameters(spark, tmp_path):
    changes(spark).createOrReplaceTempView("changes")
    path = tmp_path / "q.sql"
    path.write_text("SELECT count(*) AS n FROM changes WHERE at >= :since")
    assert reads.run_sql_file(spark, str(path), since=datetime(2024, 1, 1, 3)).first().n == 2
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        reads.run_sql(spark, "SELECT * FROM no_such_table")


def test_select_objects(spark):
    df = spark.sql("""SELECT parse_json('{"a": {"x": 1}, "b": [1, 2], "c": 3}') AS d""")
    pick = lambda *keys: df.select(F.to_json(landed.select_objects(F.col("d"), keys)).alias("v")).first().v
    assert pick("a") == '{"x":1}'
    assert pick("c", "b", "zz") == '{"b":[1,2],"c":3}'
    assert pick() == '{"a":{"x":1},"b":[1,2],"c":3}'

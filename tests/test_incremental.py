import json
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import bookmarks, chunks
from tidemark.operators.documents import installment_table, installments_for, product_configurations, reject_errors
from tidemark.plans import ingest, staging
from tidemark.plans.catalog import TableCatalog
from tidemark.sinks import tables
from tidemark.streaming.incremental import append_available, landed_stream, with_day

T0 = datetime(2024, 1, 1)
RUN = datetime(2024, 2, 1, 1, 0)
hour = lambda n: T0 + timedelta(hours=n)


@pytest.mark.parametrize("hours, length, ends", [(53, 24, [24, 48, 53]), (48, 24, [24, 48]), (5, 24, [5]), (0, 24, [])])
def test_chunk_plan(spark, rows, hours, length, ends):
    plan = chunks.plan_chunks(spark, T0, hour(hours), length)
    wanted = [(i + 1, hour(([0] + ends)[i]), hour(end)) for i, end in enumerate(ends)]
    assert rows(plan) == wanted


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(1, 60), st.integers(1, 30), st.lists(st.integers(-5, 70), max_size=30))
def test_chunk_counts_agree_with_ranges(spark, span, length, moments):
    df = spark.createDataFrame([(hour(m),) for m in moments], "at timestamp")
    start, end = (F.lit(str(t)).cast("timestamp") for t in (T0, hour(span)))
    got = {r.chunk_num: r.records_count for r in chunks.chunk_counts(df, "at", start, end, length).collect()}
    bounds = [(a, min(a + length, span)) for a in range(0, span, length)]
    wanted = {i + 1: sum(a <= m <= z for m in moments) for i, (a, z) in enumerate(bounds)}
    assert got == {k: n for k, n in wanted.items() if n}
    halves = {r.chunk_num: r.records_count for r in chunks.chunk_counts(df, "at", start, end, length, half_open=True).collect()}
    assert sum(halves.values()) == sum(0 <= m <= span for m in moments)


def test_a_failing_chunk_does_not_stop_the_rest(spark, rows):
    def job(start, end):
        if start == hour(24):
            raise RuntimeError("gone")
        return 10

    code, status = chunks.backfill(spark, T0, hour(60), 24, job)
    assert code == chunks.SOME_FAILED
    assert rows(status, "chunk_num", "status", "records_count", "error") == [(1, "success", 10, None), (2, "failure", None, "gone"), (3, "success", 10, None)]
    assert tuple(chunks.summarise_chunks(status).first()) == (3, 2, 1, 20, 2)
    assert chunks.backfill(spark, T0, hour(60), 24, lambda a, b: 1)[0] == chunks.ALL_OK
    assert chunks.backfill(spark, T0, hour(60), 0, job) == (chunks.FATAL, None)


def test_backfill_range():
    assert chunks.parse_range("2024-01-01 00:00:00", None, RUN.replace(microsecond=7)) == (T0, RUN)
    with pytest.raises(ValueError):
        chunks.parse_range("2024-01-02 00:00:00", "2024-01-01 00:00:00", RUN)


def test_high_water_mark(spark):
    df = spark.createDataFrame([(hour(1),), (hour(5),), (None,)], "last_modified_date timestamp")
    assert bookmarks.high_water_mark(df, "lastModifiedDate").first().bookmark == "2024-01-01T05:00:00+00:00"
    with pytest.raises(Exception, match="no value of lastModifiedDate"):
        bookmarks.high_water_mark(df.limit(0), "lastModifiedDate").collect()


def test_high_water_mark_can_read_the_newest_partition_only(spark, tmp_path):
    df = spark.createDataFrame([(hour(1), "20240101"), (hour(30), "20240102")], "creation_date timestamp, date string")
    tables.append(df, str(tmp_path / "t"))
    lake = spark.read.parquet(str(tmp_path / "t"))
    mark = bookmarks.high_water_mark(lake, "creationDate", "date")
    assert mark.first().bookmark == "2024-01-02T06:00:00+00:00"
    plan = mark._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_bookmarks_advance(spark, rows, tmp_path):
    state = spark.createDataFrame(
        [("clients", None, "2024-01-01T00:00:00.000000Z"), ("users", None, "2024-01-01T00:00:00.000000Z"), ("gone", None, "2024-01-01T00:00:00.000000Z"),
         ("gl_accounts", "ASSET", "2023-05-05T00:00:00.000000Z"), ("gl_accounts", "EQUITY", "2023-05-05T00:00:00Z")],
        bookmarks.STATE_SCHEMA,
    )
    status = spark.createDataFrame([("clients", True), ("users", False), ("gl_accounts", True)], "stream string, updated boolean")
    moved = bookmarks.advance_bookmarks(state, status)
    assert rows(moved) == [
        ("clients", None, "2024-01-01T00:00:01.000000Z"),
        ("gl_accounts", "ASSET", "2020-01-01T00:00:01.000000Z"),
        ("gl_accounts", "EQUITY", "2020-01-01T00:00:01Z"),
        ("gone", None, "2024-01-01T00:00:00.000000Z"),
        ("users", None, "2024-01-01T00:00:00.000000Z"),
    ]
    path = str(tmp_path / "state")
    assert rows(bookmarks.load_state(None, state)) == rows(state)
    bookmarks.archive_state(state, path, RUN)
    bookmarks.archive_state(moved, path, RUN + timedelta(seconds=1))
    assert rows(bookmarks.load_state(spark.read.parquet(path), state)) == rows(moved)


def test_events_are_checked_and_completed(spark):
    base = {"table_name": "Clients", "endpoint": "clients:search", "request_type": "POST"}
    event = ingest.parse_event({**base, "auto_schema": "True"}, RUN.replace(microsecond=9))
    assert (event.table_name, event.request_type, event.auto_schema, event.start_date) == ("clients", "post", True, None)
    assert event.end_date == "2024-02-01T01:00:00+00:00"
    lake = spark.createDataFrame([(hour(5),)], "creation_date timestamp")
    assert ingest.parse_event({**base, "cdc_field": "creationDate"}, RUN, lake).start_date == "2024-01-01T05:00:00+00:00"
    with pytest.raises(ValueError, match="endpoint"):
        ingest.parse_event({"table_name": "x"}, RUN)
    with pytest.raises(ValueError, match="start"):
        ingest.parse_event({**base, "cdc_field": "creationDate"}, RUN)


def test_ingest_twice_from_the_high_water_mark(spark, tmp_path, rows):
    lake = str(tmp_path / "clients")
    landed = spark.createDataFrame([(f"k{i}", str(hour(i)), "5" if i else None) for i in range(4)], "encodedKey string, creationDate string, loanCycle string")
    catalog = TableCatalog({"encoded_key": "string", "creation_date": "timestamp", "loan_cycle": "int"})
    raw = {"table_name": "clients", "endpoint": "clients:search", "request_type": "post", "cdc_field": "creationDate", "end_date": "2024-02-01 00:00:00"}
    event = ingest.parse_event({**raw, "start_date": "2023-01-01 00:00:00"}, RUN)
    assert ingest.ingest(spark, event, landed, lake, RUN, catalog).first().records_count == 4
    stored = spark.read.parquet(lake)
    assert rows(stored, "encoded_key", "loan_cycle", "date")[0] == ("k0", 0, "20240101")
    assert stored.schema["creation_date"].dataType.simpleString() == "timestamp"
    # Both ends are included, so the row at the mark comes again.
    again = ingest.parse_event(raw, RUN, stored)
    assert ingest.ingest(spark, again, landed, lake, RUN, catalog).first().records_count == 1


def test_an_empty_read_writes_nothing(spark, tmp_path):
    landed = spark.createDataFrame([], "encodedKey string, creationDate string")
    event = ingest.parse_event({"table_name": "t", "endpoint": "x", "request_type": "get"}, RUN)
    assert ingest.ingest(spark, event, landed, str(tmp_path / "none"), RUN).first().records_count == 0
    assert not (tmp_path / "none").exists()


def test_response_to_table(spark):
    document = json.dumps({"data": {"fullName": "a  b", "extra": '{"x": 1}', "none": None, "tags": []}, "more": 1})
    df = spark.createDataFrame([(document,)], "d string")
    flat = ingest.process_response(df, "d", keys=("data",), clean=True, flat=True)
    shaped, types = ingest.process_records(flat, RUN)
    assert types == {"extra_x": "int", "full_name": "string", "tags": "string", "date": "string", "timestamp_extracted": "timestamp"}
    row = shaped.first()
    assert (row.extra_x, row.full_name, row.tags, row.date) == (1, "a b", "[]", "20240201")


def test_response_kept_nested(spark):
    data = {"a": "x\n\ny  z", "b": {"c": ["p\tq", 1.5]}, "d": "k\\n", "e": "\\\n", "f": []}
    df = spark.createDataFrame([(json.dumps({"data": data}),)], "d string")

    def kept(**options):
        return json.loads(ingest.process_response(df, "d", keys=("data",), **options).select(F.to_json("d").alias("d")).first().d)

    assert kept() == data
    assert kept(clean=True) == {"a": "x y z", "b": {"c": ["p q", 1.5]}, "d": "k\\n", "e": "\\ ", "f": []}


def documents(spark):
    sample = {
        "dueDate": "2016-09-06T13:37:50+03:00",
        "encodedKey": "k",
        "fee": {"amount": {"due": 0, "paid": 2.5}},
        "feeDetails": [{"amount": {"due": 1}, "id": "f"}],
        "customFields": {},
        "isPaymentHoliday": True,
    }
    docs = [
        ("a", json.dumps({"installments": [sample, {**sample, "encodedKey": "l", "feeDetails": []}]})),
        ("b", json.dumps({"errors": [{"errorReason": "INVALID_LOAN_ACCOUNT_ID"}, {"errorReason": "X"}]})),
        ("c", json.dumps({"installments": [sample]})),
        ("d", "not json"),
    ]
    return spark.createDataFrame(docs, "loan_account_id string, document string")


def test_installments(spark, rows):
    accounts = spark.createDataFrame([("a",), ("a",), ("b",), ("d",)], "id string")
    flat, rejects = installments_for(documents(spark), accounts, run_ts=RUN)
    table = installment_table(flat)
    assert rows(table, "loan_account_id", "encoded_key", "due_date", "fee_amount_paid", "fee_details", "fee_details_0_amount_due", "custom_fields") == [
        ("a", "k", datetime(2016, 9, 6, 10, 37, 50), "2.5", None, "1", ""),
        ("a", "l", datetime(2016, 9, 6, 10, 37, 50), "2.5", "", None, ""),
    ]
    assert rows(rejects) == [("b", "INVALID_LOAN_ACCOUNT_ID", "warning"), ("b", "X", "error"), ("d", None, "error")]


def test_product_configurations(spark, rows):
    df = spark.createDataFrame([(json.dumps({"loanProducts": [{"id": "p", "loanAmount": {"max": 5}, "fees": []}, {"id": "q"}]}),)], "document string")
    assert rows(product_configurations(df), "id", "loan_amount_max", "fees") == [("p", "5", ""), ("q", None, None)]
    assert reject_errors(df, "document", "loanProducts").isEmpty()


def table_rows(spark):
    spark.catalog.refreshTable("sink_tests.t")
    return spark.table("sink_tests.t")


def test_catalog_tables_with_comments(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS sink_tests")
    df = spark.createDataFrame([(1, "20240101"), (2, "20240102")], "k int, date string")
    tables.append(df, "sink_tests.t", comments={"k": "the key"})
    tables.append(df.filter("k = 2"), "sink_tests.t")
    tables.overwrite_partitions(df.filter("k = 2").withColumn("k", F.lit(5)), "sink_tests.t")
    table = spark.table("sink_tests.t")
    assert rows(table, "k", "date") == [(1, "20240101"), (5, "20240102")]
    assert table.schema["k"].metadata.get("comment") == "the key"
    tables.append(df.filter("k = 1").select("date", F.lit("x").alias("more")), "sink_tests.t")
    assert rows(table_rows(spark), "k", "more") == [(1, None), (5, None), (None, "x")]
    tables.overwrite_table(df.filter("k = 1"), "sink_tests.t", ("date",))
    assert rows(table_rows(spark), "k") == [(1,)]


def test_a_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    """REBALANCE splits a partition value that holds most of the batch."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    try:
        df = spark.range(60_000).select(F.xxhash64("id").alias("v"), F.when(F.col("id") % 10 == 0, "a").otherwise("hot").alias("date"))
        tables.append(df, str(tmp_path / "hot"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "hot" / "date=hot").glob("*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 60_000


def test_write_status(spark, rows):
    def broken():
        raise RuntimeError("disk")

    status = tables.write_streams(spark, [("a", lambda: True), ("b", lambda: False), ("c", broken)])
    assert rows(status) == [("a", True, None), ("b", False, None), ("c", False, "disk")]


def test_available_now_adds_only_what_is_new(spark, tmp_path):
    drop, lake, checkpoint = (str(tmp_path / n) for n in ("drop", "lake", "checkpoint"))
    schema = "id int, at timestamp"

    def run():
        append_available(landed_stream(spark, drop, schema, max_files=1), lake, checkpoint, lambda df: with_day(df, "at"))
        return spark.read.parquet(lake).count()

    spark.createDataFrame([(1, T0)], schema).write.mode("append").json(drop)
    assert (run(), run()) == (1, 1)
    spark.createDataFrame([(2, hour(30)), (3, hour(31))], schema).write.mode("append").json(drop)
    assert (run(), run()) == (3, 3)
    assert spark.read.parquet(lake).filter("date = '20240102'").count() == 2


class _Cluster:
    class conf:
        @staticmethod
        def get(key, default=None):
            return {"spark.master": "yarn"}.get(key, default)


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_dir(_Cluster())


def test_staged_tables_lie_in_the_shared_folder(spark):
    staged = staging.stage(spark.range(3), "x")
    assert spark.conf.get("spark.checkpoint.dir") in staged.inputFiles()[0]


def test_only_staged_tables_are_released(spark, tmp_path):
    path = staging.new_path(spark, "x")
    staging.stage(spark.range(3), path=path)
    staging.release(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError, match="not a staged table"):
        staging.release(spark, str(tmp_path))


def test_append_keeps_the_types_of_the_table(spark, tmp_path):
    path = str(tmp_path / "typed")
    tables.append(spark.createDataFrame([(7, "2024-01-01")], "n long, date string"), path)
    tables.append(spark.createDataFrame([("8", "2024-01-02", 1.5)], "n string, date string, extra double"), path)
    rows = spark.read.option("mergeSchema", True).parquet(path)
    assert dict(rows.dtypes)["n"] == "bigint"
    assert {r["n"] for r in rows.collect()} == {7, 8}
    for value in ("7.5", 7.5):
        with pytest.raises(Exception, match="does not fit"):
            tables.append(spark.createDataFrame([(value, "2024-01-03")], ["n", "date"]), path)
    assert rows.count() == 2

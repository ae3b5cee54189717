import json
from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import bookmarks
from tidemark.operators.customfields import CHANNEL_COLUMN
from tidemark.operators.reconcile import SPECS, result_catalog
from tidemark.plans import catalog, ingest, jobs
from tidemark.plans.streams import STREAMS
from tidemark.sinks import tables

RUN = datetime(2024, 2, 1, 1, 0)


def test_streams_make_events():
    for stream in STREAMS.values():
        event = ingest.parse_event(stream.event(start_date="2024-01-01 00:00:00"), RUN)
        assert event.request_type == ("post" if stream.cdc_field else "get")
    assert len(STREAMS) == 14


def test_load_streams(spark, tmp_path, rows):
    folder, lake = tmp_path / "landed", str(tmp_path / "lake")
    folder.mkdir()
    (folder / "gl_accounts-1.jsonl").write_text('{"gl_code": "1", "tags": [], "creation_date": "2024-01-01T00:00:00.5Z"}\n{"gl_code": "2", "more": {"x": 1}}\n')
    (folder / "users-1.jsonl").write_text('{"id": "1"\n')
    state = spark.createDataFrame(
        [(s, sub, "2024-01-01T00:00:00.000000Z") for s, sub in (("gl_accounts", "ASSET"), ("users", None), ("clients", None))], bookmarks.STATE_SCHEMA
    )
    status, moved = jobs.load_streams(spark, str(folder), lake, ["gl_accounts", "users", "clients"], RUN, state)
    assert rows(status, "stream", "updated") == [("clients", False), ("gl_accounts", True), ("users", False)]
    assert rows(moved, "stream", "bookmark")[1] == ("gl_accounts", "2020-01-01T00:00:01.000000Z")
    stored = spark.read.parquet(f"{lake}/gl_accounts")
    assert rows(stored, "gl_code", "tags", "more_x", "date") == [("1", "", None, "20240201"), ("2", None, "1", "20240201")]
    assert stored.schema["creation_date"].dataType.simpleString() == "timestamp"
    # The same day again replaces the partition.
    jobs.load_streams(spark, str(folder), lake, ["gl_accounts"], RUN, state)
    assert spark.read.parquet(f"{lake}/gl_accounts").count() == 2
    stored = spark.read.parquet(f"{lake}/gl_accounts")
    landed = jobs.stream_table(spark, str(folder), "gl_accounts", RUN)
    compared = jobs.compare_stream(landed, stored.filter("gl_code = '2'").withColumn("gl_code", F.col("gl_code").cast("int")), "gl_code")
    assert rows(compared) == [("1", "left_only"), ("2", "both")]


def test_backfill_ingest(spark, tmp_path, rows):
    lake = str(tmp_path / "clients")
    days = ("2024-01-01 05:00:00", "2024-01-02 00:00:00", "2024-01-02 23:00:00", "2024-01-09 00:00:00")
    landed = spark.createDataFrame([(str(i), day) for i, day in enumerate(days)], "encodedKey string, creationDate string")
    raw = {**STREAMS["clients"].event(start_date="2024-01-01 00:00:00", end_date="2024-01-03 12:00:00"), "cdc_field": "creationDate"}
    types = catalog.from_names(["encoded_key", "creation_date"])
    code, status = jobs.backfill_ingest(spark, raw, landed, lake, RUN, types)
    assert code == 0 and rows(status, "chunk_num", "records_count") == [(1, 2), (2, 2), (3, 0)]
    # The row on the boundary of two chunks is there twice.
    assert rows(spark.read.parquet(lake), "encoded_key") == [("0",), ("1",), ("1",), ("2",)]
    assert jobs.backfill_ingest(spark, {**raw, "start_date": "soon"}, landed, lake, RUN, types) == (1, None)
    bad = landed.withColumn("creationDate", F.regexp_replace("creationDate", "2024-01-02 23.*", "junk"))
    assert jobs.backfill_ingest(spark, raw, bad, str(tmp_path / "bad"), RUN, types)[0] == 2


def test_reconcile_stream(spark, tmp_path, rows):
    spec, lake, results, debug = SPECS["deposit_transactions"], *(str(tmp_path / n) for n in ("lake", "results", "debug"))
    schema = "id string, creation_date string, amount string, currency_code string, type string"
    source = spark.createDataFrame([(str(i), "2024-01-31 05:00:00", "1.5", "GBP", "D") for i in range(3)], schema)
    read = lambda: spark.read.option("mergeSchema", "true").parquet(lake)
    tables.append(source.filter("id = '0'").withColumn("creation_date", F.lit("2024-01-30")).withColumn("date", F.lit("x")), lake)
    assert jobs.reconcile_stream(spec, source, read, results, RUN) == ("no_target_rows", None)
    tables.append(source.filter("id = '0'").withColumn("date", F.lit("x")), lake)
    outcome, checks = jobs.reconcile_stream(spec, source, read, results, RUN, debug_root=debug)
    assert outcome == "mismatch" and rows(checks, "source", "target", "status") == [(3.0, 1.0, -1)]
    assert spark.read.option("header", "true").csv(f"{debug}/debug_deposit_transactions_recon/20240201/010000.csv").count() == 3
    later = RUN.replace(hour=2)
    outcome, checks = jobs.reconcile_stream(spec, source, read, results, later, append_late=lambda df: tables.append(df, lake))
    assert outcome == "match" and rows(checks, "source", "target", "status") == [(3.0, 3.0, 0)]
    kept = tables.read_csv(spark, results, result_catalog(spec))
    assert rows(kept, "target_total_rowcount_for_date", "timestamp_extracted") == [(1, RUN), (3, later)]


def test_refresh_installments(spark, tmp_path, rows):
    def document(*keys):
        return json.dumps({"installments": [{"encodedKey": k, "dueDate": "2024-01-01T00:00:00Z"} for k in keys]})

    docs = spark.createDataFrame([("a", document("1", "2")), ("b", document("3")), ("c", '{"errors": []}')], "loan_account_id string, document string")
    accounts = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    target = str(tmp_path / "t")
    assert rows(jobs.refresh_installments(docs, accounts, target, RUN)) == []
    again = spark.createDataFrame([("a", document("9"))], docs.schema)
    jobs.refresh_installments(again, accounts, target, RUN)
    assert rows(spark.read.parquet(target), "loan_account_id", "encoded_key") == [("a", "9"), ("b", "3")]


def test_refresh_products(spark, tmp_path, rows):
    target = str(tmp_path / "p")
    for name in ("old", "new"):
        docs = spark.createDataFrame([(json.dumps({"loanProducts": [{"productName": name, "creationDate": "2024-01-01T00:00:00Z"}]}),)], "document string")
        jobs.refresh_products(docs, target, RUN)
    assert rows(spark.read.parquet(target), "product_name", "creation_date") == [("new", datetime(2024, 1, 1))]


def test_extract_channel_fields(spark, tmp_path, rows):
    slots = {f"custom_fields_{i}_{p}": F.lit("v") for i in range(5) for p in ("field_set_id", "id", "value")}
    df = spark.createDataFrame([("1", "Card_a"), ("2", "none")], f"id string, {CHANNEL_COLUMN} string")
    df = df.withColumns({**slots, "encoded_key": F.lit("k"), "date": F.lit("20240101"), "timestamp_extracted": F.current_timestamp()})
    jobs.extract_channel_fields(df, str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    assert rows(stored, "id") == [("1",)] and len(stored.columns) == 19


def test_pivot_table(spark, tmp_path, rows):
    schema = "id string, encoded_key string, creation_date string, custom_fields_0_id string, custom_fields_0_value string"
    df = spark.createDataFrame([("1", "k", "2024-01-01 02:00:00", "term_id", "5"), ("2", "l", None, "other", "6"), ("3", "m", None, "FTD", None)], schema)
    catalog.create_database(spark, "pivot_tests")
    jobs.pivot_table(df, ["term_id", "FTD"], "pivot_tests.fields", RUN, slots=1, comments={"term_id": "Term"})
    table = spark.table("pivot_tests.fields")
    assert rows(table, "id", "creation_date", "term_id", "FTD", "date") == [
        ("1", datetime(2024, 1, 1, 2), "5", "None", "20240201"),
        ("3", None, "None", "0", "20240201"),
    ]
    assert table.schema["term_id"].metadata["comment"] == "Term"

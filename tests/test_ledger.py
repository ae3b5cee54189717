"""Tables written batch by batch, and what their commits tell later runs."""

import json
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import flatten as flattening
from tidemark.operators import leaves
from tidemark.operators.diff import compare_keys
from tidemark.operators.digests import compare_days, differences
from tidemark.operators.documents import installments_for, installments_known
from tidemark.operators.reconcile import SPECS, partial_figures, reconcile, reconcile_parts
from tidemark.plans import ingest as ingest_module
from tidemark.plans import jobs
from tidemark.plans.catalog import TableCatalog
from tidemark.plans.ingest import parse_event
from tidemark.sinks import keyed, ledger, records, schemas, tables
from tidemark.sinks.ledger import Settings
from tidemark.sources import pages
from tidemark.sources.reads import read_table
from tidemark.streaming.incremental import append_available, ingest_available, landed_lines, landed_stream, with_day

RUN = datetime(2024, 2, 1, 1, 0)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_records_take_each_number_once(spark, tmp_path):
    folder = str(tmp_path / "r")
    assert records.latest(spark, folder) == (0, None)
    assert records.put(spark, folder, 1, {"a": 1}) and not records.put(spark, folder, 1, {"a": 2})
    assert records.latest(spark, folder) == (1, {"a": 1})
    for n in range(2, records.KEPT + 3):
        assert records.put(spark, folder, n, {"a": n})
    # Old ones go, and nothing is left lying beside them.
    assert sorted(p.name for p in (tmp_path / "r").iterdir() if not p.name.startswith(".")) == [f"{n:020d}.json" for n in range(3, records.KEPT + 3)]
    assert not [p for p in (tmp_path / "r").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def batch(spark, *ids, day="20240101"):
    return spark.createDataFrame([(i, f"v{i}", day) for i in ids], "id long, v string, date string")


def test_a_numbered_batch_is_committed_once(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    assert ledger.commit(batch(spark, 1, 2), path, "s", 0) == 2
    assert ledger.commit(batch(spark, 1, 2), path, "s", 0) is None
    assert ledger.commit(batch(spark, 3), path, "s", 1) == 1
    assert ledger.commit(batch(spark, 1), path, "s", 0) is None
    # Another writer has numbers of its own, and batches without a number are all new.
    assert ledger.commit(batch(spark, 4), path, "u", 0) == 1
    assert [ledger.commit(batch(spark, 5), path) for _ in range(2)] == [1, 1]
    assert ledger.commit(batch(spark).limit(0), path, "s", 2) == 0
    assert rows(ledger.read(spark, path), "id") == [(1,), (2,), (3,), (4,), (5,), (5,)]
    state = ledger.state(spark, path)
    assert state.writers == {"s": 2, "u": 0} and records.names(spark, f"{path}/_begun") == []
    # Readers that know nothing of commits see the same rows.
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(ValueError, match="no name"):
        ledger.commit(batch(spark, 1), path, "a/b", 0)


def test_a_batch_that_failed_half_way_is_not_seen_and_is_written_again(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    ledger.commit(batch(spark, 1), path, "s", 0)

    def lost(*args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(records, "put", lost)
        with pytest.raises(RuntimeError):
            ledger.commit(batch(spark, 2, 3).unionByName(batch(spark, 9, day="20240109")), path, "s", 1)
    assert spark.read.parquet(path).count() == 4
    assert rows(ledger.read(spark, path), "id") == [(1,)]
    # The replay has other rows: nothing of the first attempt stays.
    ledger.commit(batch(spark, 2), path, "s", 1)
    assert rows(ledger.read(spark, path), "id") == [(1,), (2,)] and spark.read.parquet(path).count() == 2


def test_a_batch_whose_writer_was_lost_after_its_commit_counts(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    ledger.commit(batch(spark, 1), path, "s", 0)
    records.mark(spark, f"{path}/_begun/s.0")
    assert rows(ledger.read(spark, path), "id") == [(1,)]
    ledger.commit(batch(spark, 2), path, "s", 1)
    assert rows(ledger.read(spark, path), "id") == [(1,), (2,)]


def test_a_commit_in_between_is_noticed(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    known = ledger.create(spark, path, Settings(change="v"))
    ledger.commit(batch(spark, 1), path, after=known.number)
    with pytest.raises(ledger.Behind):
        ledger.commit(batch(spark, 2), path, after=known.number)
    assert rows(ledger.read(spark, path), "id") == [(1,)] and spark.read.parquet(path).count() == 1


def test_a_table_of_other_files_is_not_taken_over(spark, tmp_path):
    tables.append(batch(spark, 1), str(tmp_path / "t"))
    with pytest.raises(ValueError, match="no commit names"):
        ledger.commit(batch(spark, 2), str(tmp_path / "t"))
    ledger.commit(batch(spark, 1), str(tmp_path / "u"))
    with pytest.raises(ValueError, match="batch by batch"):
        tables.overwrite_partitions(batch(spark, 1), str(tmp_path / "u"))


def test_stream_repair_stream(spark, tmp_path, rows):
    drop, lake, checkpoint = (str(tmp_path / n) for n in ("drop", "lake", "checkpoint"))
    schema = "id int, at timestamp"

    def stream(*ids):
        spark.createDataFrame([(i, datetime(2024, 1, i)) for i in ids], schema).write.mode("append").json(drop)
        append_available(landed_stream(spark, drop, schema), lake, checkpoint, lambda df: with_day(df, "at"))

    stream(1, 2)
    tables.append(spark.createDataFrame([("3", "2024-01-03 00:00:00", "20240201", 1.5)], "id string, at string, date string, more double"), lake)
    stream(4)
    got = read_table(spark, lake)
    assert rows(got, "id", "date", "more") == [(1, "20240101", None), (2, "20240102", None), (3, "20240201", 1.5), (4, "20240104", None)]
    assert got.schema["id"].dataType.simpleString() == "int"
    with pytest.raises(ValueError, match="id: x does not fit int"):
        tables.append(spark.createDataFrame([("x", "20240201")], "id string, date string"), lake)
    # A checkpoint that lost its last batch hands it out again.
    last = max((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    append_available(landed_stream(spark, drop, schema), lake, checkpoint, lambda df: with_day(df, "at"))
    assert ledger.read(spark, lake).count() == 4


def test_landed_text_to_table_by_micro_batches(spark, tmp_path, rows):
    drop, lake, checkpoint, registry = (tmp_path / "drop", *(str(tmp_path / n) for n in ("lake", "checkpoint", "leaves")))
    drop.mkdir()
    types = TableCatalog({"id": "int", "at": "timestamp", "in_x": "double"})

    def run(name, *documents):
        (drop / name).write_text("".join(json.dumps(d) + "\n" for d in documents) + "\n")
        ingest_available(landed_lines(spark, str(drop), max_files=1), lake, checkpoint, registry, RUN, cdc_field="at", catalog=types)

    run("a.jsonl", {"id": 1, "at": "2024-01-05T01:00:00Z", "in": {"x": 1.5}, "e": []}, {"id": 2, "at": "2024-01-06T01:00:00Z"})
    run("b.jsonl", {"id": 3, "at": "2024-01-06T02:00:00Z", "in": {"x": 2, "y": "new"}})
    run("c.jsonl")
    got = read_table(spark, lake)
    assert rows(got, "id", "in_x", "in_y", "date") == [(1, 1.5, None, "20240105"), (2, 0.0, None, "20240106"), (3, 2.0, "new", "20240106")]
    assert ledger.bookmark(spark, lake) == "2024-01-06T02:00:00.000000+00:00"


def test_the_schema_log_knows_columns_of_later_files_only(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    amount = [(1, Decimal("1.50"), "20240101")]
    tables.append(spark.createDataFrame(amount, "id int, amount decimal(10,2), date string"), path)
    tables.append(spark.createDataFrame([(2, 7, "20240101")], "id int, level int, date string"), path)
    tables.append(spark.createDataFrame([("3", "2.5", "8", "20240102")], "id string, amount string, level string, date string"), path)
    got = read_table(spark, path)
    assert dict(got.dtypes) == {"id": "int", "amount": "decimal(10,2)", "level": "int", "date": "string"}
    assert rows(got, "id", "amount", "level") == [(1, Decimal("1.50"), None), (2, None, 7), (3, Decimal("2.50"), 8)]
    files = sorted((tmp_path / "t").rglob("*.parquet"))
    misfits = [("level", "x"), ("level", "1.5"), ("amount", "1.234"), ("amount", "123456789012"), ("id", "99999999999")]
    for column, value in misfits:
        with pytest.raises(ValueError, match=f"{column}: {value} does not fit"):
            tables.append(spark.createDataFrame([(value, "20240103")], f"{column} string, date string"), path)
    with pytest.raises(ValueError, match="does not fit"):
        tables.append(spark.createDataFrame([([1], "20240103")], "id array<int>, date string"), path)
    assert sorted((tmp_path / "t").rglob("*.parquet")) == files
    # A table that is replaced starts a schema of its own.
    tables.overwrite_table(spark.createDataFrame([("a", "20240101")], "id string, date string"), path, ("date",))
    assert dict(read_table(spark, path).dtypes) == {"id": "string", "date": "string"}


def test_the_schema_of_files_that_were_there_before_the_log(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a")], "id int, date string").write.partitionBy("date").parquet(path)
    spark.createDataFrame([(2, "b")], "level int, date string").write.mode("append").partitionBy("date").parquet(path)
    assert schemas.logged_schema(spark, path) is None
    tables.append(spark.createDataFrame([("5", "c")], "level string, date string"), path)
    assert dict(read_table(spark, path).dtypes) == {"id": "int", "level": "int", "date": "string"}


def transactions(spark, ids, day="2024-01-31", columns="id string, creation_date timestamp, amount double, currency_code string, type string"):
    return spark.createDataFrame([(str(i), datetime.fromisoformat(day), 1.5, "GBP", "D") for i in ids], columns)


def dated(rows, day):
    return rows.withColumn("date", F.lit(day))


def test_reconciliation_reads_only_the_partitions_that_hold_the_day(spark, tmp_path, rows):
    spec, path = SPECS["deposit_transactions"], str(tmp_path / "lake")
    day = date(2024, 1, 31)
    ledger.create(spark, path, Settings(day="creation_date", stream=spec.stream))
    assert ledger.day_partitions(spark, path, day) == []
    ledger.commit(dated(transactions(spark, range(3)), "20240131"), path)
    ledger.commit(dated(transactions(spark, range(50), "2024-01-30"), "20240130"), path)
    # A repair of the day before, and rows of the day that came with a later one.
    ledger.commit(dated(transactions(spark, [3]), "20240205"), path)
    assert ledger.day_partitions(spark, path, day) == ["20240131", "20240205"]
    found = ledger.rows_of_day(spark, path, day)
    assert "PartitionFilters: [date" in plan_of(found) and found.count() == 4
    assert found.select(F.input_file_name()).distinct().count() == 2
    source = transactions(spark, range(6))
    outcome, checks, late = jobs.reconcile_table(spec, source, path, RUN)
    assert (outcome, late) == ("mismatch", None) and rows(checks, "source", "target", "status") == [(6.0, 4.0, -1)]
    outcome, checks, late = jobs.reconcile_table(spec, source, path, RUN, repair=True)
    assert outcome == "match" and rows(late, "id") == [("4",), ("5",)]
    assert ledger.day_partitions(spark, path, day) == ["20240131", "20240201", "20240205"]
    assert jobs.reconcile_table(spec, source, path, RUN, repair=True)[2] is None
    assert jobs.reconcile_table(spec, source, path, RUN + timedelta(days=9))[0] == "no_target_rows"
    everything = reconcile(spec, source, ledger.read(spark, path))
    from_parts = reconcile_parts(spec, partial_figures(spec, source, "source"), ledger.figures(spark, path))
    assert rows(everything) == rows(from_parts) and "lake/date" not in plan_of(from_parts)


def test_figures_of_half_written_batches_do_not_count(spark, tmp_path, rows, monkeypatch):
    spec, path = SPECS["deposit_accounts"], str(tmp_path / "lake")
    ledger.create(spark, path, Settings(day="creation_date", stream=spec.stream))
    ledger.commit(dated(transactions(spark, [1, 1, 2]), "20240131"), path, "s", 0)
    with monkeypatch.context() as patched:
        patched.setattr(records, "put", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ledger.commit(dated(transactions(spark, [2, 3]), "20240131"), path, "s", 1)
    assert rows(ledger.figures(spark, path), "key", "n") == [("1", 2), ("2", 1)]
    ledger.commit(dated(transactions(spark, [2, 3]), "20240131"), path, "s", 1)
    merged = reconcile_parts(spec, partial_figures(spec, transactions(spark, [1, 2, 3]), "source"), ledger.figures(spark, path))
    assert rows(merged, "target_total_rowcount_for_date", "target_total_deposit_accounts_for_date") == [(5, 3)]


def test_folded_facts_are_the_facts(spark, tmp_path, rows, monkeypatch):
    path, day = str(tmp_path / "lake"), date(2024, 1, 31)
    for spec in (SPECS["deposit_accounts"], SPECS["deposit_transactions"]):
        path = str(tmp_path / spec.stream)
        ledger.create(spark, path, Settings(day="creation_date", stream=spec.stream))
        for n, ids in enumerate(([1, 1, 2], [2, 3], [9])):
            ledger.commit(dated(transactions(spark, ids), f"2024020{n}"), path, "s", n)
        before = rows(ledger.figures(spark, path).groupBy("day").agg(F.sum("n"))), ledger.day_partitions(spark, path, day)
        merged = rows(reconcile_parts(spec, ledger.figures(spark, path), ledger.figures(spark, path)))
        ledger.fold(spark, path)
        assert (rows(ledger.figures(spark, path).groupBy("day").agg(F.sum("n"))), ledger.day_partitions(spark, path, day)) == before
        assert rows(reconcile_parts(spec, ledger.figures(spark, path), ledger.figures(spark, path))) == merged
        # A batch that is on its way while the facts are folded brings its own along.
        keep = ledger._keep_facts

        def late(*args):
            done = keep(*args)
            monkeypatch.setattr(ledger, "_keep_facts", keep)
            ledger.fold(spark, path)
            return done

        monkeypatch.setattr(ledger, "_keep_facts", late)
        ledger.commit(dated(transactions(spark, [5, 6]), "20240209"), path, "s", 3)
        assert ledger.figures(spark, path).agg(F.sum("n")).first()[0] == 8
        assert ledger.day_partitions(spark, path, day) == [*before[1], "20240209"]
        assert sorted(n for n in records.names(spark, path) if n.startswith("_days")) == ["_days-1", "_days-2"]
        assert ledger.commit(dated(transactions(spark, [5, 6]), "20240209"), path, "s", 3) is None


CATALOG = TableCatalog({"encoded_key": "string", "creation_date": "timestamp"})
EVENT = {"table_name": "clients", "endpoint": "clients:search", "request_type": "post", "cdc_field": "creationDate", "end_date": "2024-02-01 00:00:00"}


def landed(spark, *hours):
    return spark.createDataFrame([(f"k{h}", str(datetime(2024, 1, 1) + timedelta(hours=h))) for h in hours], "encodedKey string, creationDate string")


def test_the_next_ingest_starts_at_the_last_commit_without_reading_the_lake(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "lake")
    with pytest.raises(ValueError, match="no table to take the start from"):
        jobs.ingest_next(spark, EVENT, landed(spark, 1), path, RUN, CATALOG)
    jobs.ingest_next(spark, {**EVENT, "start_date": "2023-01-01 00:00:00"}, landed(spark, 1, 5), path, RUN, CATALOG)
    assert ledger.bookmark(spark, path) == "2024-01-01T05:00:00.000000+00:00"
    monkeypatch.setattr(ledger, "read", lambda *a: pytest.fail("the lake was read"))
    summary = jobs.ingest_next(spark, EVENT, landed(spark, 1, 5, 7, 30), path, RUN, CATALOG).first()
    assert (summary.records_count, summary.start_date) == (3, "2024-01-01T05:00:00.000000+00:00")
    assert ledger.bookmark(spark, path) == "2024-01-02T06:00:00.000000+00:00"
    # Nothing new: the mark stays.
    jobs.ingest_next(spark, {**EVENT, "start_date": "2024-01-20 00:00:00"}, landed(spark, 1), path, RUN, CATALOG)
    assert ledger.bookmark(spark, path) == "2024-01-02T06:00:00.000000+00:00"


def test_a_range_of_iso_text_reaches_the_scan(spark, tmp_path, monkeypatch):
    folder, seen = str(tmp_path / "landed"), []
    rows = [("k1", "2023-12-01T00:00:00Z"), ("k2", "2024-01-10T23:00:00-05:00"), ("k3", "2024-01-11T02:00:00Z"), ("k4", "2024-03-01T00:00:00Z")]
    spark.createDataFrame(rows, "encodedKey string, creationDate string").write.parquet(folder)
    event = parse_event({**EVENT, "start_date": "2024-01-11 03:00:00", "end_date": "2024-01-12 00:00:00"}, RUN)
    read = ingest_module.read_stream
    monkeypatch.setattr(ingest_module, "read_stream", lambda df, *a, **o: seen.append(plan_of(df)) or read(df, *a, **o))
    for iso_text in (False, True):
        assert ingest_module.ingest(spark, event, spark.read.parquet(folder), str(tmp_path / f"t{iso_text}"), RUN, CATALOG, iso_text=iso_text).first().records_count == 1
    assert "GreaterThanOrEqual(creationDate,2024-01-09)" not in seen[0] and "GreaterThanOrEqual(creationDate,2024-01-09)" in seen[1]


def test_two_ingests_at_once_do_not_append_the_same_range(spark, tmp_path, monkeypatch):
    path, first = str(tmp_path / "lake"), {**EVENT, "start_date": "2023-01-01 00:00:00"}
    jobs.ingest_next(spark, first, landed(spark, 1), path, RUN, CATALOG)
    create = ledger.create

    def slow(*args):
        known = create(*args)
        monkeypatch.setattr(ledger, "create", create)
        jobs.ingest_next(spark, EVENT, landed(spark, 1, 2), path, RUN, CATALOG)
        return known

    monkeypatch.setattr(ledger, "create", slow)
    with pytest.raises(ledger.Behind):
        jobs.ingest_next(spark, EVENT, landed(spark, 1, 2), path, RUN, CATALOG)
    assert ledger.read(spark, path).count() == 3


def test_a_backfill_reads_its_landed_records_once(spark, tmp_path, rows):
    path, reads = str(tmp_path / "lake"), spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    source = landed(spark, 5, 24, 30, 24 * 6).mapInArrow(seen, "encodedKey string, creationDate string")
    raw = {**EVENT, "start_date": "2024-01-01 00:00:00", "end_date": "2024-01-07 00:00:00.5", "chunk_hours": 12}
    code, status = jobs.backfill_ingest(spark, raw, source, path, RUN, CATALOG)
    assert code == 0 and status.count() == 13 and reads.value == 4
    # Rows on a boundary belong to both chunks.
    assert sum(r.records_count for r in status.collect()) == 6
    assert rows(read_table(spark, path).groupBy("encoded_key").count()) == [("k144", 2), ("k24", 2), ("k30", 1), ("k5", 1)]
    assert rows(status, "end_date")[-1] == ("2024-01-07 00:00:00.500000",)


def test_digests_find_what_a_comparison_of_all_keys_finds(spark, rows):
    at = lambda n: datetime(2024, 1, 1) + timedelta(hours=n)
    schema = "k long, at timestamp, other int"
    source = [(i, at(i), 1) for i in range(200)] + [(None, at(3), 1), (7, at(99), 1), (8, None, 1), (500, None, 1), (5, at(5), 1)]
    target = [(i, at(i + (48 if i % 10 == 0 else 0)), 1) for i in range(200) if i % 17] + [(900, at(3), 1), (901, None, 1), (8, None, 1), (6, at(150), 1)]
    for a, b in ((source, target), (source, source), (source, []), ([], target), ([], [])):
        left, right = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
        wanted = rows(compare_keys(left, right, ["k"]), "k", "provenance")
        for buckets in (1, 16):
            assert rows(compare_days(left, right, ["k"], "at", buckets=buckets), "k", "provenance") == wanted
            assert rows(differences(left, right, ["k"], "at", buckets=buckets), "k", "provenance") == [w for w in wanted if w[1] != "both"]
    with pytest.raises(ValueError, match="bigint in the source"):
        compare_days(spark.createDataFrame(source, schema), spark.createDataFrame(target, schema).withColumn("k", F.col("k").cast("string")), ["k"], "at")


def test_keys_are_replaced_in_their_buckets_only(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    keyed.replace_keys(spark.createDataFrame([(str(i), i) for i in range(40)] + [(None, -1)], "k string, v int"), path, "k", 8)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    keyed.replace_keys(spark.createDataFrame([("3", "100"), ("3", "101"), ("99", "5")], "k string, v string"), path, "k", 99)
    wanted = [(str(i), i) for i in range(40) if i != 3] + [("3", 100), ("3", 101), ("99", 5), (None, -1)]
    assert rows(read_table(spark, path)) == sorted(wanted, key=repr)
    assert rows(keyed.read_keyed(spark, path, ["3", "7"])) == [("3", 100), ("3", 101), ("7", 7)]
    folders = [p.name for p in (tmp_path / "t").iterdir() if "=" in p.name]
    assert len(folders) <= 8
    kept = [p for p, t in before.items() if p.exists() and p.stat().st_mtime_ns == t]
    assert len({p.parent for p in before}) - len({p.parent for p in kept}) <= 2
    # A column that comes later, a null key, and a batch of nothing.
    keyed.replace_keys(spark.createDataFrame([(None, 7, "x")], "k string, v int, w string"), path, "k")
    keyed.replace_keys(spark.createDataFrame([], "k string, v int"), path, "k")
    assert (None, 7, "x") in rows(read_table(spark, path)) and (None, -1, None) not in rows(read_table(spark, path))
    with pytest.raises(ValueError, match="keyed by k"):
        keyed.replace_keys(spark.createDataFrame([(1,)], "v int"), path, "v")


def records_frame(spark, *documents):
    return spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)], "n int, d string").select("n", F.parse_json("d").alias("d"))


def test_known_paths_are_extended_by_the_records_that_differ(spark, tmp_path, rows, monkeypatch):
    registry = str(tmp_path / "registry")
    first = [{"a": 1, "l": [{"x": 1}, {"y": 2}], "e": []}, {"a": None, "b": {"c": 1.25}}]
    searched = []
    find = leaves.find_leaves
    monkeypatch.setattr(leaves, "find_leaves", lambda df, column, **o: searched.append(df.count()) or find(df, column, **o))
    batches = [
        first,
        [{"a": 12.5, "l": [{"x": 3}, {"y": 1}], "e": []}, {"a": "text", "b": {"c": 100}}],
        # Other keys together; the merged shape of before, but with its parts elsewhere; a longer list; a filled list; an object for a number.
        [{"a": 1}, {"a": 1, "l": [{"x": 1, "y": 2}, {}], "e": []}, {"l": [{"x": 1}, {"y": 2}, {"x": 5}]}, {"e": [None]}, {"a": {"deep": True}}],
        [{"a": {"deep": False}}, {"a": 5, "l": [{"x": 1, "y": 2}, {}], "e": []}],
    ]
    for documents in batches:
        df = records_frame(spark, *documents)
        got = leaves.flatten_known(df, "d", registry)
        wanted = flattening.flatten(df, "d")
        assert set(wanted.columns) <= set(got.columns)
        assert rows(got, *wanted.columns) == rows(wanted)
    # Both of the first batch; none of the second; all of the third; none of the fourth.
    assert searched == [2, 5]


def test_documents_with_known_paths_are_parsed_once(spark, tmp_path, rows, monkeypatch):
    def schedule(*keys, **more):
        return json.dumps({"installments": [{"encodedKey": k, "fee": {"due": 1}, "tags": [], **more} for k in keys]})

    def frame(*docs):
        return spark.createDataFrame(docs, "loan_account_id string, document string")

    accounts = spark.createDataFrame([(k,) for k in "abcdef"], "id string")
    error = json.dumps({"errors": [{"errorReason": "INVALID_LOAN_ACCOUNT_ID"}, {"errorReason": "X"}]})
    docs = frame(("a", schedule("1", "2")), ("b", error), ("c", "{}"), ("d", "junk"), ("e", json.dumps({"installments": []})), ("z", schedule("9")))
    registry = str(tmp_path / "registry")
    wanted = [rows(df, *cols) for df, cols in zip(installments_for(docs, accounts), (("loan_account_id", "encodedKey", "fee_due", "tags"), ("loan_account_id", "reason", "severity")))]
    installments_known(docs, accounts, registry)
    monkeypatch.setattr(leaves, "find_leaves", lambda *a, **o: pytest.fail("searched again"))
    flat, rejects = installments_known(docs, accounts, registry)
    assert [rows(flat, "loan_account_id", "encodedKey", "fee_due", "tags"), rows(rejects)] == wanted
    # Both results come from the staged pass; the documents are not read for them.
    assert "parse_json" not in plan_of(flat) + plan_of(rejects)
    monkeypatch.undo()
    flat, _ = installments_known(frame(("a", schedule("5", extra="new"))), accounts, registry)
    assert rows(flat, "encodedKey", "extra", "fee_due") == [("5", "new", "1")]


@pytest.mark.parametrize("near", [10, 100_000])
def test_slices_by_counted_ranges(spark, near):
    hot = [(7, i % 4, i) for i in range(600)]
    data = [(None, None, -1)] * 3 + [(i, None, i) for i in range(40)] + hot + [(9, 1, 1)] * 50 + [(i, 2, i) for i in range(100, 180)]
    df = spark.createDataFrame(data, "a int, b int, c int").repartition(5)
    order = sorted(data, key=lambda r: tuple((x is not None, x or 0) for x in r[:2]) + (json.dumps({k: v for k, v in zip("abc", r) if v is not None}, separators=(",", ":")),))
    for offset in (0, 2, 11, 45, 300, 640, 655, 700, 770, 10_000):
        got = [tuple(r) for r in pages.page_slice(df, ["a", "b"], offset, 37, near=near).collect()]
        assert got == order[offset : offset + 37], offset


def test_slices_of_text_and_times(spark):
    df = spark.range(3000).select(F.concat(F.lit("k"), F.col("id") % 3).alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("at"), "id")
    wanted = sorted(range(3000), key=lambda i: (i % 3, i))
    for offset in (990, 1500, 2980):
        assert [r.id for r in pages.page_slice(df, ["k", "at"], offset, 30, near=50).collect()] == wanted[offset : offset + 30]

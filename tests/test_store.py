"""Upsert, views, jobs, streams and sampling on small stores."""

import csv
import glob
import gzip
import os
import random
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import raw_frame
from ordermill.operators.classify import classify, quarantined
from ordermill.operators.reports import run_report, sales_by_period, top_products
from ordermill.operators.lookups import run_lookup
from ordermill.operators.sampling import header_bytes, prefix_while, size_sample, widening_sample
from ordermill.plans import ingest as ingest_module, jobs
from ordermill.plans.ingest import ingest, ingest_files, rollback
from ordermill.plans.views import read_view, refresh_all, view_control
from ordermill.schema import BUSINESS_FIELDS, PHYSICAL_FIELDS
from ordermill.sinks.keyed_table import KeyedTable
from ordermill.sinks.layers import split_rows
from ordermill.sinks import layouts
from ordermill.sinks.layouts import layout_lookup, write_layouts
from ordermill.sources.order_csv import numbered, raw_envelope, raw_records, row_number_source, scan_orders, with_lineage
from ordermill.streaming.directory import failed_files, ingest_directory
from ordermill.streaming.refresh import is_due, refresh_on_commit, report_by_clock, report_on_commit


def envelope(spark, rows, id_run):
    return raw_frame(spark, rows, id_run).withColumns(
        {"at_ingested": F.current_timestamp(), "engine_used": F.lit("spark")}
    )


def order(i, **more):
    return {"order_id": f"O{i:03d}", "order_date": f"2025-01-{1 + i % 9:02d}", "city": f"C{i % 3}",
            "items": f'[{{"sku": "P{i % 4}", "qty": {1 + i % 3}, "price": 10.5}}]',
            "total_amount": None, **more}


def view_rows(store, name):
    return sorted(tuple(r) for r in read_view(store, name).drop("updated_at").collect())


def ids(df):
    return sorted(r["order_id"] for r in df.select("order_id").collect())


def actions(store, version):
    """Of a version, or of a change set by name."""
    table = store.validated_table
    name = version if isinstance(version, str) else table.snapshot(version).change_set
    rows = table.actions(name).groupBy("action").count().collect()
    return {r["action"]: r["count"] for r in rows}


FIRST = [order(i) for i in range(30)]
SECOND = (
    [order(i) for i in range(0, 10)]
    + [order(i, order_date="2025-02-01") for i in range(10, 15)]
    + [order(i, items='[{"sku": "NEW", "price": 1}]') for i in range(15, 18)]
    + [order(i) for i in range(30, 36)]
)


@pytest.fixture(scope="module")
def two_runs(spark, tmp_path_factory):
    from ordermill.plans.store import OrderStore

    store = OrderStore(spark, str(tmp_path_factory.mktemp("two")), 4)
    ingest(store, envelope(spark, FIRST, "r1"), "r1")
    refresh_all(store)
    ingest(store, envelope(spark, SECOND, "r2"), "r2")
    return store


def test_upsert_actions_and_tracking(two_runs):
    assert actions(two_runs, 1) == {"inserted": 30}
    assert actions(two_runs, 2) == {"unchanged": 10, "updated": 8, "inserted": 6}
    rows = {r["order_id"]: r for r in two_runs.validated().collect()}
    assert len(rows) == 36
    assert (rows["O012"]["last_run_id"], rows["O012"]["first_seen_run_id"]) == ("r2", "r1")
    assert rows["O012"]["created_at"] < rows["O012"]["last_updated_at"]
    assert (rows["O003"]["last_run_id"], rows["O033"]["first_seen_run_id"]) == ("r1", "r2")
    assert rows["O012"]["order_date"] == "2025-02-01"


def test_earlier_versions_stay_readable(two_runs):
    table = two_runs.validated_table
    assert table.read(table.snapshot(1)).count() == 30


def test_a_small_delivery_reads_its_buckets_only(spark, new_store, monkeypatch):
    store = new_store(buckets=8)
    ingest(store, envelope(spark, FIRST, "r1"), "r1")
    table, read = store.validated_table, []
    rows = KeyedTable._rows
    monkeypatch.setattr(KeyedTable, "_rows", lambda self, live: read.append({p.bucket for p in live}) or rows(self, live))
    ingest(store, envelope(spark, [order(3, city="Elsewhere")], "r2"), "r2")
    own = spark.range(1).select(table.bucket(F.lit("O003"), 8)).first()[0]
    assert read and all(buckets <= {own} for buckets in read)
    monkeypatch.undo()
    assert actions(store, 2) == {"updated": 1} and store.validated().count() == 30


def test_unchanged_delivery_writes_nothing(spark, two_runs):
    before = two_runs.validated_table.snapshot()
    result = ingest(two_runs, envelope(spark, SECOND, "r3"), "r3")
    assert two_runs.validated_table.snapshot() == before
    assert actions(two_runs, result.change_set) == {"unchanged": 24}
    row = two_runs.run_metrics().where("id_run = 'r3'").first()
    assert row["idempotent_run"] and row["upsert_applied"] and row["consistency_check_passed"]


def test_incremental_views_equal_full_ones(two_runs):
    modes = [r["mode"] for r in refresh_all(two_runs)]
    assert modes == ["incremental", "incremental"]
    names = ("daily_sales_summary", "top_products_summary")
    incremental = [view_rows(two_runs, n) for n in names]
    refresh_all(two_runs, force_full=True)
    assert incremental == [view_rows(two_runs, n) for n in names]
    products = [r[0] for r in incremental[1]]
    assert "NEW" in products
    expected = {r["product"]: r["revenue"] for r in top_products(two_runs.validated(), 99).collect()}
    assert {r[0]: r[1] for r in incremental[1]} == expected
    assert view_control(two_runs).count() == 2


def test_every_report_and_lookup_runs(two_runs):
    validated = two_runs.validated()
    for name in ("sales_by_city", "top_products", "top_customers", "sales_by_period",
                 "orders_status_distribution"):
        assert run_report(validated, name).count() > 0
    assert ids(run_lookup(validated, "orders_by_customer", {"customer_id": "C-318"}, 5))
    assert run_lookup(validated, "orders_by_payment", {}, 100).count() == 36
    with pytest.raises(ValueError):
        run_lookup(validated, "orders_by_status", {}, 0)


def test_layouts_answer_like_the_table(two_runs, tmp_path):
    validated = two_runs.validated()
    made = write_layouts(two_runs.validated_table, str(tmp_path / "layouts"), files=3)
    for name, params in (("orders_by_status", {"status": "confirmed"}),
                         ("orders_by_customer", {"customer_id": "C-318"})):
        assert (
            layout_lookup(two_runs.validated_table, made, name, params).collect()
            == run_lookup(validated, name, params).collect()
        )


def test_layouts_follow_the_table(spark, new_store, tmp_path, monkeypatch):
    monkeypatch.setattr(layouts, "RUNS", 2)
    store = new_store()
    table, root = store.validated_table, str(tmp_path / "layouts")
    ingest(store, envelope(spark, FIRST, "r0"), "r0")
    made = {"orders_by_customer": layouts.layouts(table, root, 2)["orders_by_customer"]}
    made["orders_by_customer"].build()

    def answers(**how):
        params = {"customer_id": "C-318"}
        from_layout = layout_lookup(table, made, "orders_by_customer", params, 100, **how).collect()
        assert from_layout == run_lookup(store.validated(), "orders_by_customer", params, 100).collect()
        return {r["order_id"]: r["city"] for r in from_layout}

    answers()
    runs = []
    for n in range(1, 5):
        ingest(store, envelope(spark, [order(i, city=f"moved {n}") for i in range(n, n + 2 + 20 * (n == 4))], f"r{n}"), f"r{n}")
        with pytest.raises(layouts.StaleLayout):
            answers()
        assert answers(top_up=True)["O002"] == f"moved {min(n, 2)}"
        runs.append(len(made["orders_by_customer"].state().runs))
    # The third run is merged with the second; what the fourth brings is a share of the table, so all are merged.
    assert runs == [2, 2, 2, 1]
    rollback(store, "r4")
    assert "O010" not in answers(top_up=True) and answers()["O001"] == "moved 1"


def test_rollback_and_refresh(new_store, spark):
    store = new_store()
    ingest(store, envelope(spark, FIRST + [{"order_id": ""}], "r1"), "r1")
    ingest(store, envelope(spark, SECOND + [{"order_id": ""}], "r2"), "r2")
    refresh_all(store)
    rollback(store, "r2")
    assert ids(store.validated()) == [f"O{i:03d}" for i in range(30) if not 10 <= i < 18]
    assert [r["id_run"] for r in store.quarantine().select("id_run").distinct().collect()] == ["r1"]
    refresh_all(store)
    incremental = view_rows(store, "top_products_summary")
    assert "NEW" not in [r[0] for r in incremental]
    refresh_all(store, force_full=True)
    assert incremental == view_rows(store, "top_products_summary")


def test_rollback_restores_replaced_orders(new_store, spark):
    def order(i, city, **more):
        return {"order_id": f"O{i:03d}", "city": city, **more}

    def state():
        rows = store.validated().select("order_id", "city", "last_run_id", "first_seen_run_id").collect()
        return {r[0]: tuple(r)[1:] for r in rows}

    store = new_store()
    ingest(store, envelope(spark, [order(i, "Aden") for i in range(20)], "r1"), "r1")
    refresh_all(store)
    whole = sorted(map(str, store.validated().collect()))
    second = [order(i, "Taiz", order_date="2024-07-01") for i in range(10, 24)] + [{"order_id": ""}]
    ingest(store, envelope(spark, second, "r2"), "r2")
    # The third run changes two of the orders again; those keep what it wrote.
    ingest(store, envelope(spark, [order(12, "Mocha"), order(22, "Mocha")], "r3"), "r3")
    rollback(store, "r2", restore=True)
    expected = {f"O{i:03d}": ("Aden", "r1", "r1") for i in range(20)}
    expected |= {"O012": ("Mocha", "r3", "r1"), "O022": ("Mocha", "r3", "r2")}
    assert state() == expected
    assert store.quarantine().count() == 0
    version = store.validated_table.snapshot().version
    rollback(store, "r2", restore=True)
    assert store.validated_table.snapshot().version == version
    # The run comes again after the third and is undone again: its commits are two now.
    ingest(store, envelope(spark, second, "r2"), "r2")
    assert state()["O012"] == ("Taiz", "r2", "r1")
    rollback(store, "r2", restore=True)
    assert state() == expected
    rollback(store, "r3", restore=True)
    # What the third run replaced was the second run's; that one's commits undo it in turn.
    assert state()["O012"][:2] == ("Taiz", "r2")
    rollback(store, "r2", restore=True)
    assert sorted(map(str, store.validated().collect())) == whole
    rollback(store, "never", restore=True)
    refresh_all(store)
    incremental = [view_rows(store, name) for name in ("daily_sales_summary", "top_products_summary")]
    refresh_all(store, force_full=True)
    assert incremental == [view_rows(store, name) for name in ("daily_sales_summary", "top_products_summary")]


def test_large_change_sets_take_the_shuffle_path(new_store, spark, monkeypatch):
    from ordermill.sinks import keyed_table

    monkeypatch.setattr(keyed_table, "BROADCAST_KEYS", 0)
    store = new_store()
    ingest(store, envelope(spark, FIRST, "r1"), "r1")
    ingest(store, envelope(spark, SECOND, "r2"), "r2")
    assert store.validated().count() == store.validated().select("order_id").distinct().count() == 36


def test_crash_before_commit_changes_nothing_and_a_rerun_repairs(new_store, spark, monkeypatch):
    store = new_store()
    ingest(store, envelope(spark, FIRST, "r1"), "r1")
    before = sorted(map(str, store.validated().select(*BUSINESS_FIELDS).collect()))

    def die(self, snapshot):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_publish", die)
        with pytest.raises(RuntimeError):
            ingest(store, envelope(spark, SECOND, "r2"), "r2")
    assert before == sorted(map(str, store.validated().select(*BUSINESS_FIELDS).collect()))
    ingest(store, envelope(spark, SECOND, "r2"), "r2")
    assert store.validated().count() == 36
    assert store.raw().where("id_run = 'r2'").count() == len(SECOND)


def test_jobs_are_recorded_also_when_they_fail(new_store, spark, monkeypatch):
    store = new_store()
    ingest(store, envelope(spark, FIRST, "r1"), "r1")
    assert jobs.run_job(store, "generate_periodic_report")["status"] == "success"
    report = store.periodic_reports()
    assert report.select("generated_at").distinct().count() == 1
    assert {r["section"] for r in report.collect()} == set(jobs.SECTIONS)

    def fail(_):
        raise KeyError("gone")

    monkeypatch.setitem(jobs.JOBS, "refresh_materialized_views", jobs.Job(fail, "broken"))
    record = jobs.run_job(store, "refresh_materialized_views")
    assert record["status"] == "failure" and record["error"].startswith("KeyError")
    listed = {r["job_name"]: r["status"] for r in jobs.list_jobs(store).collect()}
    assert listed == {"generate_periodic_report": "success", "refresh_materialized_views": "failure"}
    with pytest.raises(ValueError):
        jobs.run_job(store, "unknown")


def write_csv(spark, rows, path):
    """Records as one physical CSV file in list order."""
    raw = raw_frame(spark, rows).coalesce(1).orderBy("number_row_source")
    physical = dict(zip(raw.select("record_raw.*").columns, PHYSICAL_FIELDS))
    raw.coalesce(1).select(
        *[F.col(f"record_raw.{l}").alias(p) for l, p in physical.items()]
    ).write.option("header", True).option("quote", '"').option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)


def test_directory_stream_resumes(new_store, spark, tmp_path):
    store = new_store()
    inbox = str(tmp_path / "inbox")
    write_csv(spark, FIRST, f"{inbox}/chunk_1")
    ingest_directory(store, f"{inbox}/chunk_*").awaitTermination()
    refresh_on_commit(store, None).awaitTermination()
    assert store.validated().count() == 30
    write_csv(spark, SECOND, f"{inbox}/chunk_2")
    for _ in range(2):  # the second call finds nothing new
        ingest_directory(store, f"{inbox}/chunk_*").awaitTermination()
    refresh_on_commit(store, None).awaitTermination()
    assert store.validated().count() == 36
    assert sorted(r["id_run"] for r in store.run_metrics().select("id_run").collect()) == [
        "chunk-000000", "chunk-000001",
    ]
    report_on_commit(store, None).awaitTermination()
    assert store.periodic_reports().select("generated_at").distinct().count() == 1
    incremental = view_rows(store, "daily_sales_summary")
    refresh_all(store, force_full=True)
    assert incremental == view_rows(store, "daily_sales_summary")


def test_a_bad_file_is_recorded_and_the_others_go_on(new_store, spark, tmp_path):
    store, inbox = new_store(), tmp_path / "inbox"
    inbox.mkdir()
    header = ",".join(PHYSICAL_FIELDS)

    def line(i):
        return ",".join(f"B{i}" if f == "order_id" else "2025-01-05" if f == "order_date" else "" for f in PHYSICAL_FIELDS)

    bad = inbox / "a.csv.gz"
    bad.write_text("no gzip stream")
    for n, name in enumerate(("b", "c")):
        (inbox / f"{name}.csv").write_text(f"{header}\n{line(n)}\n")
    ingest_directory(store, str(inbox), max_files=None).awaitTermination()
    assert store.raw().count() == 2 and store.run_metrics().count() == 2
    failed = failed_files(store).collect()
    assert [os.path.basename(r["path"]) for r in failed] == ["a.csv.gz"] and failed[0]["error"]
    # Unchanged it is left alone, repaired it is taken up, and new files still arrive.
    (inbox / "d.csv").write_text(f"{header}\n{line(7)}\n")
    ingest_directory(store, str(inbox)).awaitTermination()
    assert store.raw().count() == 3 and store.file_ledger().count() == 1
    bad.write_bytes(gzip.compress(f"{header}\n{line(8)}\n{line(9)}\n".encode()))
    ingest_directory(store, str(inbox)).awaitTermination()
    assert store.raw().count() == 5 and failed_files(store).isEmpty()
    assert sorted(r["record_raw"]["order_id"] for r in store.raw().collect()) == ["B0", "B1", "B7", "B8", "B9"]
    assert [r["status"] for r in store.file_ledger().orderBy("recorded_at").collect()] == ["failed", "ingested"]


def test_a_lost_row_fails_the_consistency_check(new_store, spark, monkeypatch):
    store = new_store()
    ingest(store, envelope(spark, FIRST, "r1"), "r1")
    kept = ingest_module.append_run

    def lossy(df, path):
        kept(df.where("record_raw.order_id <> 'O003'") if path.endswith("orders_raw") else df, path)

    monkeypatch.setattr(ingest_module, "append_run", lossy)
    ingest(store, envelope(spark, FIRST, "r2"), "r2")
    rows = {r["id_run"]: (r["read_rows"], r["loaded_raw"], r["consistency_check_passed"]) for r in store.run_metrics().collect()}
    assert rows == {"r1": (30, 30, True), "r2": (30, 29, False)}


def test_a_rerun_after_the_commit_records_what_was_done(new_store, spark, monkeypatch):
    store = new_store()

    def die(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(ingest_module, "metrics_row", die)
        with pytest.raises(RuntimeError):
            ingest(store, envelope(spark, FIRST, "r1"), "r1")
    ingest(store, envelope(spark, FIRST, "r1"), "r1")
    row = store.run_metrics().first()
    assert row["count_inserted"] == 30 and not row["idempotent_run"] and row["upsert_applied"]
    ingest(store, envelope(spark, FIRST, "r1"), "r1")
    assert store.run_metrics().first()["idempotent_run"]


def test_an_empty_run_is_recorded(new_store, spark):
    store = new_store()
    ingest(store, envelope(spark, FIRST, "r1").where("false"), "r1")
    assert store.run_metrics().first()["read_rows"] == 0


def test_row_numbers_follow_the_file_across_splits(spark, tmp_path):
    path = str(tmp_path / "csv")
    write_csv(spark, [order(i, customer_name=str(i)) for i in range(3000)], path)
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = raw_envelope(with_lineage(scan_orders(spark, path)), "r")
        assert raw.rdd.getNumPartitions() > 10
        rows = raw.select("number_row_source", "record_raw.customer_name").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)
    rows.sort(key=lambda r: r["number_row_source"])
    assert [r["customer_name"] for r in rows] == [str(i) for i in range(3000)]
    assert len({r["number_row_source"] for r in rows}) == 3000


@pytest.mark.parametrize("block_rows", [1, 5, 64, 1000])
@pytest.mark.parametrize("target", [0, 1, 37, 5000])
def test_prefix_matches_a_plain_loop(spark, block_rows, target):
    rng = random.Random(block_rows)
    data = [(f"f{i // 40}", i % 40, rng.randint(1, 9)) for i in range(120)]
    df = spark.createDataFrame(data, "file_source string, number_row_source long, w int")
    expected, seen = [], 0
    for row in data:
        if seen >= target:
            break
        expected.append(row)
        seen += row[2]
    got = prefix_while(df, F.col("w"), target, block_rows).collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_size_sample_keeps_the_crossing_row(spark, tmp_path):
    path = str(tmp_path / "csv")
    write_csv(spark, [order(i) for i in range(200)], path)
    lines = with_lineage(scan_orders(spark, path)).withColumn(
        "number_row_source", row_number_source(F.col("file_block_start"))
    )
    sample = size_sample(lines, PHYSICAL_FIELDS, 8000 / 1024 / 1024)
    rows = sample.select(*PHYSICAL_FIELDS).collect()
    sizes = [sum(len((v or "").encode()) for v in r) + len(PHYSICAL_FIELDS) for r in rows]
    total = header_bytes(PHYSICAL_FIELDS) + sum(sizes)
    assert total >= 8000 > total - max(sizes)


@pytest.mark.parametrize("split_bytes", ["3000", "128m"])
def test_split_files_are_exact_and_in_order(spark, tmp_path, split_bytes):
    for n in range(3):
        write_csv(spark, [order(i, customer_name=str(i)) for i in range(40 * n, 40 * n + 35 + n)], str(tmp_path / f"csv_{n}"))
    names = [str(i) for n in range(3) for i in range(40 * n, 40 * n + 35 + n)]
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        lines = numbered(with_lineage(scan_orders(spark, str(tmp_path / "csv_*"))))
        split_rows(lines, str(tmp_path / "split"), 20)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)
    found = []
    for chunk in range(6):
        (file,) = glob.glob(str(tmp_path / "split" / f"chunk={chunk}" / "*.csv"))
        with open(file, encoding="utf-8") as f:
            records = list(csv.DictReader(f))
        assert list(records[0]) == PHYSICAL_FIELDS
        assert len(records) == (20 if chunk < 5 else len(names) - 100)
        found += [r["customer_name"] for r in records]
    assert found == names


def test_a_small_sample_opens_few_files(spark, tmp_path):
    for n in range(6):
        write_csv(spark, [order(i, customer_name=f"{n}-{i}") for i in range(20)], str(tmp_path / f"csv_{n}"))
    read = []

    def scan(files):
        read.append(len(files))
        return numbered(with_lineage(scan_orders(spark, files)))

    sample, opened = widening_sample(spark, str(tmp_path / "csv_*"), 30, scan, 1)
    assert [r["customer_name"] for r in sample.orderBy("file_source", "number_row_source").collect()] == [
        f"{n}-{i}" for n in range(2) for i in range(20)][:30]
    assert opened < 6 and read == sorted(read)
    sample, opened = widening_sample(spark, str(tmp_path / "csv_*"), 1000, scan, 1)
    assert opened == 6 and sample.count() == 120


def test_bom_quotes_and_embedded_line_breaks(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_bytes(
        "﻿order_id,city\nA,\"x,\"\"y\"\"\"\nB,\"two\nlines\"\n".encode()
    )
    rows = scan_orders(spark, str(path), multi_line=True).orderBy("order_id").collect()
    assert [tuple(r) for r in rows] == [("A", 'x,"y"'), ("B", "two\nlines")]


def test_each_file_is_read_by_its_own_header(spark, new_store, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("order_id,city,total_amount\nA1,Aden,5\nA2,Taiz,6\n")
    (tmp_path / "in" / "b.csv").write_text("coupon,total_amount,order_id\nX9,7,B1\n,8,B2\n")
    (tmp_path / "in" / "c.csv").write_text("")
    raw = raw_records(spark, str(tmp_path / "in"), "r")
    rows = {r["record_raw"]["order_id"]: r for r in raw.collect()}
    got = {k: (r["record_raw"]["city"], r["record_raw"]["total_amount"], r["record_extra"]) for k, r in rows.items()}
    assert got == {
        "A1": ("Aden", "5", None), "A2": ("Taiz", "6", None), "B1": (None, "7", {"coupon": "X9"}), "B2": (None, "8", {}),
    }
    assert len({(r["file_source"], r["number_row_source"]) for r in rows.values()}) == 4

    store = new_store()
    ingest_files(store, str(tmp_path / "in"), "r")
    with pytest.raises(ValueError):
        ingest_files(store, str(tmp_path / "in" / "a.csv"), "r")
    assert store.raw().count() == 4
    ingest_files(store, str(tmp_path / "in"), "r")
    assert store.raw().count() == 4 and store.quarantine().count() == 4


def test_reports_by_the_clock_need_no_commit(new_store, spark):
    store = new_store()
    ingest(store, envelope(spark, FIRST, "r1"), "r1")
    query = report_by_clock(store, "8 seconds")
    try:
        until = time.time() + 100
        while store.job_runs().count() < 2 and time.time() < until:
            time.sleep(2)
    finally:
        query.stop()
    starts = [r["started_at"] for r in store.job_runs().orderBy("started_at").collect()]
    assert len(starts) >= 2 and (starts[1] - starts[0]).total_seconds() >= 4
    assert store.periodic_reports().select("generated_at").distinct().count() >= 2
    assert not is_due(store, "generate_periodic_report", "1 hour") and is_due(store, "refresh_materialized_views", "1 hour")


def test_a_report_of_many_statuses_is_as_many_rows(spark):
    validated = spark.range(300_000).select(
        F.concat(F.lit("s"), "id").alias("status"), F.lit("valid").alias("quality_status"), F.lit("c").alias("city"),
        F.lit(1).cast("decimal(38,2)").alias("total_amount"),
        F.lit(None).cast("array<struct<product:string,qty:double,unit_price:double>>").alias("items_norm"),
        F.col("id").cast("string").alias("order_id"),
    )
    report = jobs.periodic_report(validated)
    assert report.where("section = 'orders_status_distribution'").count() == 300_000


def test_very_large_amounts(spark, new_store):
    store = new_store()
    no_price = '[{"sku": "P1", "qty": 1}]'
    rows = [order(1, total_amount="1" + "0" * 27, items=no_price), order(2, total_amount="2" + "0" * 36, items=no_price), order(3)]
    ingest(store, envelope(spark, rows, "r1"), "r1")
    refresh_all(store)
    assert ids(store.validated()) == ["O001", "O003"]
    assert [(r["order_id_raw"], r["quarantine_code"]) for r in store.quarantine().collect()] == [("O002", "PRICE_UNKNOWN")]
    assert sum(r["total_sales"] for r in read_view(store, "daily_sales_summary").collect()) == pytest.approx(1e27)
    assert sum(r["total_sales"] for r in sales_by_period(store.validated(), "month").collect()) == pytest.approx(1e27)


def test_failed_refresh_runs_again_without_a_new_commit(new_store, spark, monkeypatch):
    store = new_store()
    ingest(store, envelope(spark, FIRST, "r1"), "r1")

    def fail(_):
        raise OSError("no space")

    with monkeypatch.context() as patched:
        patched.setitem(jobs.JOBS, "refresh_materialized_views", jobs.Job(fail, "broken"))
        with pytest.raises(StreamingQueryException):
            refresh_on_commit(store, None).awaitTermination()
    refresh_on_commit(store, None).awaitTermination()
    assert view_rows(store, "daily_sales_summary")
    assert [r["status"] for r in store.job_runs().orderBy("started_at").collect()] == ["failure", "success"]


def test_missing_columns_become_null(spark, tmp_path):
    path = tmp_path / "short.csv"
    path.write_text("order_id,delivery_cost\nA,5\n")
    row = raw_envelope(with_lineage(scan_orders(spark, str(path))), "r").first()["record_raw"]
    assert (row["order_id"], row["delivery_fee"], row["items"]) == ("A", "5", None)


def test_sales_by_day_granularity(two_runs):
    months = sales_by_period(two_runs.validated(), "month").collect()
    days = sales_by_period(two_runs.validated(), "anything").collect()
    assert {len(r["period"]) for r in months} == {7} and {len(r["period"]) for r in days} == {10}
    assert sum(r["orders_count"] for r in months) == sum(r["orders_count"] for r in days)


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_an_upsert_writes_rows_where_one_shuffle_by_id_takes_them(new_store, spark, monkeypatch, broadcast):
    from ordermill.sinks import keyed_table, order_upsert

    for module in (keyed_table, order_upsert):
        monkeypatch.setattr(module, "BROADCAST_KEYS", broadcast)
    monkeypatch.setattr(keyed_table, "TASK_ROWS", 2)
    store = new_store(buckets=8)
    with monkeypatch.context() as patched:
        patched.setattr(KeyedTable, "_write_new_rows", None)
        ingest(store, envelope(spark, [*FIRST, order(3, city="Late")], "r1"), "r1")
    table = store.validated_table
    pieces = table.pieces(table.snapshot())
    # Every file has rows of one bucket, and a bucket with many rows has several files.
    assert len(pieces) > 8 and all(p.path.startswith("changes/") for p in pieces)
    assert [r["city"] for r in store.validated().where("order_id = 'O003'").collect()] == ["Late"]
    ingest(store, envelope(spark, [*SECOND, order(12, city="Late")], "r2"), "r2")
    assert actions(store, 2) == {"inserted": 6, "updated": 9, "unchanged": 9}
    assert store.validated().count() == store.validated().select("order_id").distinct().count() == 36


@pytest.mark.parametrize("told_apart", [True, False])
def test_accepted_records_are_not_staged_again(new_store, spark, monkeypatch, told_apart):
    rows = [*FIRST, order(3, customer_id="OTHER"), order(40, order_date="2025-13-45"), order(5, customer_id="", city="X"),
            order(41), order(41, customer_id="OTHER", order_date="2025-13-45"), order(42)]
    records = envelope(spark, rows, "r1")
    if not told_apart:
        # An accepted row has the lineage of a conflicting one, and so has a rejected one.
        place = F.col("number_row_source")
        records = records.withColumn("number_row_source", F.when(place.isin(34, 35), 30).otherwise(place))
    staged, delete = [], ingest_module.delete_path

    def keep(session, path):
        if "/staging/" in path:
            staged.extend(session.read.parquet(f"{path}/ruled").select("errors", "record_raw").collect())
        return delete(session, path)

    store = new_store()
    monkeypatch.setattr(ingest_module, "delete_path", keep)
    ingest(store, records, "r1")
    assert len(staged) == len(rows) and all((r["record_raw"] is None) == (not r["errors"]) for r in staged)
    expected = quarantined(classify(store.raw())).drop("id_run")
    found = store.quarantine().select(*expected.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect())) != []


def test_shuffle_files_go_with_their_query(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {name for name in (disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size()))
                if name.startswith("shuffle_") and name.endswith(".data")}

    before = shuffled()
    grouped = spark.range(1000).groupBy(F.col("id") % 7).count()
    assert len(grouped.collect()) == 7
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    # A frame is computed again when it is asked again.
    assert len(grouped.collect()) == 7


def test_layouts_are_packed_like_the_table(two_runs, tmp_path):
    write_layouts(two_runs.validated_table, str(tmp_path / "packed"))
    files = glob.glob(str(tmp_path / "packed" / "*" / "runs" / "*" / "rows" / "part-*"))
    assert files and all(file.endswith(".zstd.parquet") for file in files)

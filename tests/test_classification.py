"""Verdicts, audit trail and the rules across rows."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import raw_frame
from ordermill.operators.classify import accepted, apply_rules, classify, quarantined
from ordermill.operators.duplicates import conflicting_rows, last_wins, repeated_last
from ordermill.operators.run_accounting import correction_rule_counts, error_code_counts, tally

CASES = [
    ({}, "valid", None, []),
    ({"total_amount": "١٦٥", "order_date": "17.6.2024"}, "corrected", None, []),
    ({"order_id": ""}, "quarantined", "ID_ORDER_MISSING", ["ID_ORDER_MISSING"]),
    ({"customer_id": ""}, "quarantined", "ID_CUSTOMER_MISSING", ["ID_CUSTOMER_MISSING"]),
    ({"items": "[{]"}, "quarantined", "JSON_ITEMS_CORRUPTED", ["JSON_ITEMS_CORRUPTED"]),
    ({"items": "[]"}, "quarantined", "ITEMS_EMPTY", ["ITEMS_EMPTY"]),
    ({"order_date": "2024-02-30"}, "quarantined", "DATE_IMPOSSIBLE_INVALID", ["DATE_IMPOSSIBLE_INVALID"]),
    ({"customer_id": "", "order_date": "1850-01-01"}, "quarantined", "ERRORS_CONFLICTING_MULTIPLE",
     ["ID_CUSTOMER_MISSING", "DATE_IMPOSSIBLE_INVALID"]),
    ({"items": "[]", "total_amount": "?"}, "quarantined", "ERRORS_CONFLICTING_MULTIPLE",
     ["ITEMS_EMPTY", "PRICE_UNKNOWN"]),
    ({"total_amount": "-5"}, "quarantined", "VALUE_NEGATIVE_AMBIGUOUS", ["VALUE_NEGATIVE_AMBIGUOUS"]),
    ({"total_amount": "?"}, "valid", None, []),
    ({"total_amount": "512"}, "corrected", None, []),
    ({"total_amount": "165.01"}, "valid", None, []),
    ({"customer_email": "a@@b"}, "corrected", None, []),
    ({"status": " packed "}, "corrected", None, []),
]


@pytest.fixture(scope="module")
def results(spark):
    rows = [{**case[0], **({} if "order_id" in case[0] else {"order_id": f"O{i}"})}
            for i, case in enumerate(CASES)]
    df = classify(raw_frame(spark, rows)).orderBy("number_row_source")
    return df.collect()


@pytest.mark.parametrize("i", range(len(CASES)))
def test_verdict(results, i):
    _, verdict, code, codes = CASES[i]
    row = results[i]
    assert (row["quality_status"], row["quarantine_code"], row["codes_error"]) == (verdict, code, codes)
    assert (row["details_error"] is None) == (code is None)


def test_recomputed_total_and_its_audit(results):
    row = results[11]
    assert float(row["total_amount"]) == 165.0
    assert [tuple(c) for c in row["corrections"]] == [
        ("total_amount", "512.00", "165.00", "TOTAL_RECOMPUTED_FROM_ITEMS")
    ]


def test_invalid_email_keeps_raw_text_but_logs_the_attempt(results):
    row = results[13]
    assert row["customer_email"] == "a@@b"
    assert row["corrections"][0]["corrected_value"] == "a@b"


def test_corrections_come_in_order(raw_of):
    row = classify(raw_of({
        "total_amount": "٩٩٩ لاير", "order_date": "31/01/2025", "currency": "yer",
        "customer_phone": "1+", "customer_email": "a@@b.c", "status": " x",
    })).first()
    assert [c["rule_code"] for c in row["corrections"]] == [
        "DATE_NORMALIZED", "ARABIC_NUMERALS+CURRENCY_TEXT_STRIPPED", "CURRENCY_NORMALIZED",
        "PHONE_NORMALIZED", "EMAIL_REPEATED_SYMBOLS", "STATUS_NORMALIZED",
        "TOTAL_RECOMPUTED_FROM_ITEMS",
    ]


def test_blank_fields(raw_of):
    row = accepted(classify(raw_of({
        "customer_email": None, "customer_phone": " ", "status": None, "currency": "", "city": "  ",
        "delivery_fee": None, "total_amount": "200",
    }))).first()
    assert (row["customer_email"], row["customer_phone"], row["status"]) == ("", " ", "")
    assert (row["currency"], row["city"], row["delivery_fee"]) == (None, None, "")


def test_conflicting_duplicate(raw_of):
    rows = classify(raw_of(
        {"order_id": "DUP1", "customer_id": "A"}, {"order_id": "DUP1", "customer_id": "B"},
        {"order_id": "DUP2"}, {"order_id": "DUP2"},
    )).orderBy("number_row_source").collect()
    assert [r["quarantine_code"] for r in rows] == [None, "ID_ORDER_DUPLICATE", None, None]


def _plain_conflicts(rows):
    seen, flagged = {}, []
    for i, row in enumerate(rows):
        key = row["order_id"].strip()
        if not key:
            continue
        mark = (row["customer_id"], row["total_amount"])
        if key in seen and seen[key] != mark:
            flagged.append(i)
        seen[key] = mark
    return flagged


@pytest.mark.parametrize("block_rows", [1, 3, 7, 1000])
def test_conflicts_match_a_plain_loop_for_any_block_size(spark, block_rows):
    rng = random.Random(block_rows)
    rows = [
        {
            "order_id": rng.choice(["HOT"] * 6 + ["A", "B", "C", ""]),
            "customer_id": rng.choice("XYZ"),
            "total_amount": rng.choice(["165", "165", "-5"]),
            "items": "[1]",  # no total can be computed from it, so the stated one stays
        }
        for _ in range(120)
    ]
    ruled = apply_rules(raw_frame(spark, rows))
    found = conflicting_rows(ruled, block_rows).collect()
    assert sorted(r["number_row_source"] for r in found) == _plain_conflicts(rows)


def test_last_accepted_row_wins_and_is_limited_before_the_shuffle(spark):
    rows = [{"order_id": f"O{i % 5}", "status": str(i)} for i in range(20)]
    kept = last_wins(accepted(classify(raw_frame(spark, rows))))
    assert sorted(r["status"] for r in kept.collect()) == sorted(str(i) for i in range(15, 20))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("WindowGroupLimit") == 2


def test_last_rows_are_found_without_a_shuffle_of_whole_rows(spark, tmp_path):
    rows = [{"order_id": f"O{i % 7 if i < 40 else i}", "status": str(i)} for i in range(60)]
    made = accepted(classify(raw_frame(spark, rows)))
    made.write.parquet(str(tmp_path / "accepted"))
    made = spark.read.schema(made.schema).parquet(str(tmp_path / "accepted"))
    repeated_last(made).write.parquet(str(tmp_path / "lasts"))
    lasts = spark.read.parquet(str(tmp_path / "lasts"))
    assert {r["order_id"]: (r["number_row_source"], r["n"]) for r in lasts.collect()} == {
        f"O{i % 7}": (i, 1) for i in range(33, 40)
    }
    kept = last_wins(made, lasts)
    assert kept.columns == made.columns
    assert sorted(kept.collect()) == sorted(last_wins(made).collect())
    assert "hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()


def test_rows_of_one_lineage_leave_one_order(spark, tmp_path, new_store):
    from ordermill.sinks.order_upsert import upsert_orders

    made = accepted(classify(raw_frame(spark, [{"order_id": "A"}, {"order_id": "B"}])))
    twice = made.unionByName(made)
    assert {r["n"] for r in repeated_last(twice).collect()} == {2}
    table = new_store().validated_table
    upsert_orders(table, twice, "run-t", datetime(2026, 1, 1))
    assert sorted(r["order_id"] for r in table.read().collect()) == ["A", "B"]


def test_quarantine_and_counts(raw_of):
    classified = classify(raw_of({"order_id": ""}, {"order_id": "Y", "customer_id": "", "items": "["}, {},
                                 {"order_id": "Z", "currency": "yer"}))
    q = {r["quarantine_code"]: r for r in quarantined(classified).collect()}
    assert q["ID_ORDER_MISSING"]["record_raw"]["customer_id"] == "C-318"
    counts = tally(classified)
    codes = {r["code"]: (r["orders_count"], r["mentions_count"]) for r in error_code_counts(counts).collect()}
    assert codes == {
        "ID_ORDER_MISSING": (1, 1), "ERRORS_CONFLICTING_MULTIPLE": (1, 0),
        "ID_CUSTOMER_MISSING": (0, 1), "JSON_ITEMS_CORRUPTED": (0, 1),
    }
    assert [tuple(r) for r in correction_rule_counts(counts).collect()] == [
        ("CURRENCY_NORMALIZED", 1, 100.0)
    ]


def test_rules_do_not_depend_on_partitioning(spark):
    rows = [{"order_id": f"O{i % 7}", "customer_id": "AB"[i % 2]} for i in range(40)]
    raw = raw_frame(spark, rows)
    one = classify(raw.coalesce(1)).select("number_row_source", "quarantine_code")
    many = classify(raw.repartition(9)).select("number_row_source", "quarantine_code")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    assert one.where(F.col("quarantine_code").isNotNull()).count() > 0

"""Order files derived from tables of a test's own."""

from datetime import datetime

import pytest

from ordermill.schema import PHYSICAL_FIELDS
from ordermill.sources import order_csv as S
from ordermill.verify import inputs

DAY = datetime(1997, 3, 5)


@pytest.fixture
def folder(spark, tmp_path):
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))

    # Order 5 is stored twice, order 7 has no lines, order 82 is delivered twice, one order has no key.
    orders = [(k, 1, "F", 1.0, DAY, "1-URGENT") for k in (82, 5, 7, 5, None, 6)]
    write("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
          "o_orderdate timestamp, o_orderpriority string")
    write("customer", [(1, "Ann", 0)], "c_custkey long, c_name string, c_nationkey int")
    write("nation", [(0, "NATION_1", 0)], "n_nationkey int, n_name string, n_regionkey int")
    write("region", [(0, "EAST")], "r_regionkey int, r_name string")
    lines = [(5, 9, 2, 3.0, 1.5), (5, 8, 1, 2.0, 4.0), (82, 1, 1, 1.0, 2.25), (6, 4, 1, 1.0, None),
             (None, 3, 1, 1.0, 1.0), (99, 3, 1, 1.0, 1.0)]
    write("lineitem", lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double")
    return str(tmp_path)


def test_items_are_collected_after_one_shuffle_of_narrow_rows(spark, folder):
    made = inputs.dirty_orders(spark, folder)
    assert [(r["k"], r["copy_no"], r["items_json"], r["payment_amount"]) for r in made.collect()] == [
        (None, 1, "[]", "10.00"),
        (5, 1, '[{"name":"P8","count":2,"item_price":4.00},{"name":"P9","count":3,"item_price":1.50}]', "22.50"),
        (5, 1, '[{"name":"P8","count":2,"item_price":4.00},{"name":"P9","count":3,"item_price":1.50}]', "22.50"),
        (6, 1, '[{"product_id":"P4","quantity":1,"unit_price":null}]', "10.00"),
        (7, 1, "[]", "10.00"),
        (82, 1, '[{"sku":"P1","qty":1,"price":2.25}]', "12.25"),
        (82, 2, '[{"sku":"P1","qty":1,"price":2.25}]', "12.25"),
    ]
    plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    # From above: nothing but projections and the window over one sort lie on the shuffle by ranges.
    above = plan[: plan.index("rangepartitioning")]
    assert "hashpartitioning" not in above and above.count("Sort [") == 1


def test_more_lines_are_sorted_by_more_tasks(spark, folder, monkeypatch):
    whole = sorted(map(str, inputs.dirty_orders(spark, folder).collect()))
    monkeypatch.setattr(inputs, "TASK_LINES", 1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        made = inputs.dirty_orders(spark, folder)
        assert sorted(map(str, made.collect())) == whole
        plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert ", 6)" in plan[plan.index("rangepartitioning"):].splitlines()[0]


def test_items_are_ordered_without_a_function_for_each_item(spark, folder):
    plan = inputs.dirty_orders(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array(" in plan and "lambda" not in plan


def test_order_files_are_zipped_and_read_back_in_order(spark, folder, tmp_path):
    made = inputs.dirty_orders(spark, folder)
    path = inputs.write_order_csv(made, str(tmp_path / "zipped"))
    assert list((tmp_path / "zipped").glob("part-*")) and not list((tmp_path / "zipped").glob("*.csv"))
    read = S.numbered(S.with_lineage(S.scan_orders(spark, path))).orderBy(*S.ROW_ORDER)
    expected = [tuple(r[c] or None for c in PHYSICAL_FIELDS) for r in made.collect()]
    assert [tuple(r[c] or None for c in PHYSICAL_FIELDS) for r in read.collect()] == expected

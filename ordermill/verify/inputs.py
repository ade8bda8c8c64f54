"""Dirty order files derived from clean order tables, and stores built from them.

The given tables hold clean data, so the order files the engine is meant for are derived from
them: every order becomes one CSV record with faults spread by order key, and some orders are
delivered a second time. ``oracle.DIRTY`` states the same derivation in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.constants import ARABIC_DIGITS, LATIN_DIGITS
from ordermill.functions.text import latin_digits
from ordermill.plans.ingest import ingest_files, rollback
from ordermill.plans.store import OrderStore
from ordermill.plans.views import refresh_all
from ordermill.schema import PHYSICAL_FIELDS
from ordermill.session import configure, fresh_dir
from ordermill.sinks.files import create_file
from ordermill.streaming.directory import ingest_directory
from ordermill.streaming.refresh import refresh_on_commit

ITEM_KEYS = [
    ("product_id", "quantity", "unit_price"),
    ("sku", "qty", "price"),
    ("name", "count", "item_price"),
]


# Lines that one task sorts and renders.
TASK_LINES = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _arabic(text: Column) -> Column:
    return F.translate(text, LATIN_DIGITS, ARABIC_DIGITS)


def _item_text() -> Column:
    """One line item as JSON text; what is missing is written as null."""

    def written(value: Column) -> Column:
        return F.coalesce(value.cast("string"), F.lit("null"))

    def rendered(keys: tuple[str, str, str]) -> Column:
        product, quantity, unit_price = keys
        return F.concat(
            F.lit(f'{{"{product}":"P'), written(F.col("l_partkey")), F.lit(f'","{quantity}":'), written(F.col("qty")),
            F.lit(f',"{unit_price}":'), written(F.col("price")), F.lit("}"),
        )

    kind = F.col("k") % 3
    return F.when(kind == 0, rendered(ITEM_KEYS[0])).when(kind == 1, rendered(ITEM_KEYS[1])).otherwise(
        rendered(ITEM_KEYS[2])
    )


def _with_items(base: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Orders in the order (k, copy_no) over all partitions, each with its rendered items and the sum of its lines.

    Orders and lines go as narrow rows through one shuffle by ranges of the order key; the items are rendered
    and collected where they arrive, so no rendered text is shuffled or sorted.
    """
    lines = lineitem.where(F.col("l_orderkey").isNotNull()).select(
        F.col("l_orderkey").alias("k"), "l_linenumber", "l_partkey", F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), F.lit(True).alias("is_line"),
    )
    rows = base.unionByName(lines, allowMissingColumns=True)
    # More tasks for more lines (counted in the files' footers), so that a task's rows are sorted in memory.
    tasks = lineitem.count() // TASK_LINES
    wide = tasks > int(lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(tasks, "k") if wide else rows.repartitionByRange("k")
    whole = (
        Window.partitionBy("k").orderBy("copy_no")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    line = F.when(F.col("is_line"), F.struct("l_linenumber", _item_text().alias("item")))
    return (
        rows.select(*base.columns, "is_line", line.alias("line"), (F.col("qty") * F.col("price")).alias("line_total"))
        .select(
            *base.columns, "is_line", F.collect_list("line").over(whole).alias("lines"),
            F.sum("line_total").over(whole).cast("decimal(18,2)").alias("lines_total"),
        )
        .where(F.col("is_line").isNull())
        .sortWithinPartitions("k", "copy_no")
        .withColumn("items", F.sort_array("lines")["item"])
        .drop("is_line", "lines")
    )


# Orders dated before this day make up the first of two deliveries.
FIRST_DELIVERY_ENDS = "2008-01-01"


def dirty_orders(spark: SparkSession, sf_dir: str, delivery: int = 0) -> DataFrame:
    """One record per delivered order, in the order (k, copy_no): the physical CSV columns plus these two.

    Delivery 0 is everything at once. Delivery 1 holds the older orders; delivery 2 everything
    again, with orders in transit moved to the next day and pending ones without their first item.
    """
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    day = F.add_months(F.col("o_orderdate").cast("date"), 120)
    if delivery == 1:
        orders = orders.where(day < F.lit(FIRST_DELIVERY_ENDS).cast("date"))
    k = F.col("o_orderkey")
    copies = F.when(k % 41 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    base = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            k.alias("k"), F.explode(copies).alias("copy_no"), "o_orderdate", "o_orderstatus", "o_orderpriority",
            "o_custkey", "c_name", "n_name", "r_name",
        )
    )
    base, k = _with_items(base, table(spark, sf_dir, "lineitem")), F.col("k")
    items = F.col("items")
    if delivery == 2:
        day = F.when(F.col("o_orderstatus") == "O", F.date_add(day, 1)).otherwise(day)
        items = F.when(
            F.col("o_orderstatus") == "P", F.slice(items, F.lit(2), F.greatest(F.size(items), F.lit(1)))
        ).otherwise(items)
    iso = F.date_format(day, "yyyy-MM-dd")
    week_date = F.format_string(
        "%04d-W%02d-%d", F.extract(F.lit("YEAROFWEEK"), day), F.weekofyear(day), F.weekday(day) + 1
    )
    total = (F.coalesce("lines_total", F.lit(0)) + 10).cast("decimal(18,2)")
    total_text = total.cast("string")

    def text(c: Column) -> Column:
        return c.cast("string")

    suffix = F.when((F.col("copy_no") == 2) & (k % 82 == 0), F.lit("X")).otherwise(F.lit(""))
    columns = {
        "order_id": F.when(k % 97 == 0, "").otherwise(F.concat(F.lit("ORD"), text(k))),
        "order_date": F.when(k % 67 == 0, "2025-13-45")
        .when(k % 11 == 0, F.date_format(day, "yyyy/MM/dd"))
        .when(k % 11 == 1, F.date_format(day, "dd-MM-yyyy"))
        .when(k % 11 == 2, _arabic(iso))
        .when(k % 11 == 3, F.date_format(day.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss"))
        .when(k % 11 == 4, F.date_format(day, "yyyyMMdd"))
        .when(k % 11 == 5, week_date)
        .otherwise(iso),
        "status": F.when(F.col("o_orderstatus") == "P", "مؤكد")
        .when(F.col("o_orderstatus") == "F", "تم التسليم")
        .otherwise(" قيد الشحن "),
        "customer_id": F.when(k % 89 == 0, "").otherwise(
            F.concat(F.lit("CUST"), text(F.col("o_custkey")), suffix)
        ),
        "customer_name": F.col("c_name"),
        "customer_phone": F.concat(
            F.when(k % 7 == 0, "967+ 77 ").otherwise("+96777"), text(k + 1000000)
        ),
        "customer_email": F.concat(
            F.lit("u"), text(k), F.when(k % 6 == 0, "@@mail..com").otherwise("@mail.com")
        ),
        "city": F.when(F.col("n_name") == "NATION_0", "").otherwise(F.col("n_name")),
        "district": F.col("r_name"),
        "delivery_type": F.lit("standard"),
        "delivery_cost": F.lit("10"),
        "payment_method": F.col("o_orderpriority"),
        "payment_status": F.col("o_orderstatus"),
        "payment_amount": total_text,
        "currency": F.when(k % 5 == 0, "لاير يمني").when(k % 5 == 1, "YER")
        .when(k % 5 == 2, "usd").when(k % 5 == 3, "ريال سعودي").otherwise("EUR"),
        "total_amount": F.when(k % 73 == 0, "unknown")
        .when(k % 71 == 0, "-5")
        .when(k % 13 == 0, F.concat(_arabic(total_text), F.lit(" لاير")))
        .when(
            k % 13 == 1,
            F.concat(F.substring(total_text, 1, 1), F.lit(","), total_text.substr(F.lit(2), F.length(total_text))),
        )
        .when(k % 13 == 2, "خمسة آلاف")
        .when(k % 13 == 3, text((total + 100).cast("decimal(18,2)")))
        .otherwise(total_text),
        "items_json": F.when(k % 61 == 0, "{broken").otherwise(
            F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
        ),
    }
    assert list(columns) == PHYSICAL_FIELDS
    return base.select("k", "copy_no", *[c.alias(n) for n, c in columns.items()])


def write_order_csv(
    orders: DataFrame, path: str, encoding: str = "UTF-8", columns: list[str] = PHYSICAL_FIELDS
) -> str:
    """Write records as CSV whose (file, row) order is the delivery order (k, copy_no), in which they come.

    Files are zipped, a fifth of the text; each holds the orders of some ``TASK_LINES`` lines, so it is one split.
    """
    (
        orders.select(*columns)
        .write.option("header", True)
        .option("compression", "gzip")
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .mode("errorifexists")
        .csv(path)
    )
    return path


# One session derives the files of a data folder once; every query then reads the files.
_written: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, label: str, build):
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        _written[key] = build()
    return _written[key]


def order_files(spark: SparkSession, sf_dir: str, delivery: int = 0) -> str:
    """Folder of CSV files holding all dirty orders of a data folder."""
    configure(spark)
    return once(
        spark, sf_dir, f"csv-{delivery}",
        lambda: write_order_csv(
            dirty_orders(spark, sf_dir, delivery), fresh_dir(spark, f"orders-csv-{delivery}")
        ),
    )


def mixed_header_files(spark: SparkSession, sf_dir: str) -> str:
    """Orders with even k by the usual header; the others with reversed columns and a column more."""
    configure(spark)

    def build() -> str:
        path, orders = fresh_dir(spark, "orders-mixed"), dirty_orders(spark, sf_dir)
        write_order_csv(orders.where("k % 2 = 0"), f"{path}/a")
        odd = orders.where("k % 2 = 1").withColumn("coupon", F.concat(F.lit("C"), "k"))
        write_order_csv(odd, f"{path}/b", columns=["coupon", *reversed(PHYSICAL_FIELDS)])
        return f"{path}/*"

    return once(spark, sf_dir, "csv-mixed", build)


def windows_1256_files(spark: SparkSession, sf_dir: str) -> str:
    """The same records in windows-1256, which has no Arabic-Indic digits: those are Latin."""
    configure(spark)

    def build() -> str:
        orders = dirty_orders(spark, sf_dir).withColumns(
            {c: latin_digits(F.col(c)) for c in PHYSICAL_FIELDS}
        )
        return write_order_csv(orders, fresh_dir(spark, "orders-1256"), "windows-1256")

    return once(spark, sf_dir, "csv-1256", build)


def store(spark: SparkSession, sf_dir: str) -> OrderStore:
    """All orders ingested in one run."""
    def build() -> OrderStore:
        made = OrderStore(spark, fresh_dir(spark, "store"))
        ingest_files(made, order_files(spark, sf_dir), "run-1")
        return made

    return once(spark, sf_dir, "store", build)


def two_delivery_store(spark: SparkSession, sf_dir: str) -> OrderStore:
    """Two runs with a view refresh after each; then the second run is rolled back.

    Versions of the validated table: 1 after the first run, 2 after the second, 3 rolled back.
    """
    def build() -> OrderStore:
        made = OrderStore(spark, fresh_dir(spark, "store-two"))
        for delivery in (1, 2):
            ingest_files(made, order_files(spark, sf_dir, delivery), f"run-{delivery}")
            refresh_all(made)
        rollback(made, "run-2")
        return made

    return once(spark, sf_dir, "store-two", build)


def restored_store(spark: SparkSession, sf_dir: str) -> OrderStore:
    """Two runs with a view refresh after each; then the second is rolled back with what it had replaced."""
    def build() -> OrderStore:
        made = OrderStore(spark, fresh_dir(spark, "store-restored"))
        for delivery in (1, 2):
            ingest_files(made, order_files(spark, sf_dir, delivery), f"run-{delivery}")
            refresh_all(made)
        rollback(made, "run-2", restore=True)
        refresh_all(made)
        return made

    return once(spark, sf_dir, "store-restored", build)


def store_beside_bad_file(spark: SparkSession, sf_dir: str) -> OrderStore:
    """The two deliveries arriving in a watched directory with a file between them that is not what it says."""
    def build() -> OrderStore:
        made, inbox = OrderStore(spark, fresh_dir(spark, "store-bad")), fresh_dir(spark, "inbox-bad")
        for delivery in (1, 0, 2):
            if delivery:
                write_order_csv(dirty_orders(spark, sf_dir, delivery), f"{inbox}/chunk_{delivery}")
            else:
                # No gzip stream, whatever its name says.
                create_file(spark, f"{inbox}/chunk_bad/orders.csv.gz", "order_id,city\n1,Aden\n")
            ingest_directory(made, f"{inbox}/chunk_*", max_files=None).awaitTermination()
        return made

    return once(spark, sf_dir, "store-bad", build)


def streamed_store(spark: SparkSession, sf_dir: str) -> OrderStore:
    """The two deliveries arriving in a watched directory, views refreshed by the commit stream."""
    def build() -> OrderStore:
        made = OrderStore(spark, fresh_dir(spark, "store-stream"))
        inbox = fresh_dir(spark, "inbox")
        for delivery in (1, 2):
            write_order_csv(dirty_orders(spark, sf_dir, delivery), f"{inbox}/chunk_{delivery}")
            ingest_directory(made, f"{inbox}/chunk_*", max_files=None).awaitTermination()
            refresh_on_commit(made, None).awaitTermination()
        return made

    return once(spark, sf_dir, "store-stream", build)

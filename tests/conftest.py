import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ordermill.session import configure  # noqa: E402


def make_session() -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("ordermill-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture(scope="session")
def spark():
    return make_session()


GOOD_ROW = {
    "order_id": "K-7741",
    "customer_id": "C-318",
    "customer_email": "mona@shop.example",
    "customer_phone": "+966505550142",
    "order_date": "2024-06-17",
    "items": '[{"product_id": "lamp", "quantity": 3, "unit_price": 45.5}, {"sku": "cup", "qty": 2, "price": 8}]',
    "currency": "SAR",
    "delivery_fee": "12.5",
    "total_amount": "165",
    "status": "packed",
}


def raw_frame(session, rows, id_run="run-t"):
    """Raw envelope rows from overrides of a good record, in list order."""
    from ordermill.schema import LOGICAL_FIELDS, RECORD_RAW
    from pyspark.sql import types as T

    schema = T.StructType(
        [
            T.StructField("id_run", T.StringType()),
            T.StructField("file_source", T.StringType()),
            T.StructField("number_row_source", T.LongType()),
            T.StructField("record_raw", RECORD_RAW),
        ]
    )
    data = []
    for i, override in enumerate(rows):
        record = {**GOOD_ROW, **override}
        data.append((id_run, "file", i, tuple(record.get(f) for f in LOGICAL_FIELDS)))
    return session.createDataFrame(data, schema)


@pytest.fixture
def raw_of(spark):
    return lambda *rows: raw_frame(spark, rows)


@pytest.fixture
def new_store(spark, tmp_path):
    from ordermill.plans.store import OrderStore

    return lambda name="store", buckets=4: OrderStore(spark, str(tmp_path / name), buckets)

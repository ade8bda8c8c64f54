"""Aggregation reports on validated orders."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.constants import UNKNOWN_CITY
from ordermill.functions.items import line_price, line_revenue, line_units
from ordermill.operators.run_accounting import percent, rounded_quotient
from ordermill.schema import MONEY

Params = dict[str, object]

# A top-k result is joined back by broadcast only up to this many keys.
BROADCAST_TOP = 10_000


def business_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("quality_status").isin("valid", "corrected"))


def money_sum(column: str) -> Column:
    """Exact sum; zero where every amount is missing."""
    return F.coalesce(F.sum(column), F.lit(0).cast(MONEY))


def money_double(amount: Column) -> Column:
    return F.round(amount, 2).cast("double")


def money_average(total: Column, n: Column) -> Column:
    """Average to the cent, half up, from an exact sum; null without any amount."""
    cents = (total * 100).cast("decimal(38,0)")
    return rounded_quotient(cents * 2, n).cast("double") / F.lit(100.0)


def sales_by_city(validated: DataFrame, limit: int = 20) -> DataFrame:
    grouped = business_rows(validated).groupBy("city").agg(
        money_sum("total_amount").alias("total"),
        F.count(F.lit(1)).alias("orders_count"),
        F.count("total_amount").alias("priced"),
    )
    return (
        grouped.orderBy(F.desc("total"), F.asc_nulls_first("city"))
        .limit(limit)
        .select(
            F.coalesce("city", F.lit(UNKNOWN_CITY)).alias("city"),
            money_double(F.col("total")).alias("total_sales"),
            "orders_count",
            money_average(F.col("total"), F.col("priced")).alias("avg_order_value"),
        )
    )


def item_lines(validated: DataFrame) -> DataFrame:
    """One row per item line of the accepted orders; only the typed items column is read."""
    line = F.col("line")
    return (
        business_rows(validated)
        .select(F.explode("items_norm").alias("line"))
        .select(
            "line.product",
            line_units(line).alias("units"),
            line_revenue(line).alias("revenue"),
        )
    )


def items_normalized(validated: DataFrame) -> DataFrame:
    """Item lines in uniform shape with the order they belong to."""
    return (
        business_rows(validated)
        .select("order_id", F.explode("items_norm").alias("line"))
        .select(
            "order_id", "line.product", "line.qty", line_price(F.col("line")).alias("unit_price")
        )
    )


def top_products(validated: DataFrame, limit: int = 10) -> DataFrame:
    """Products by revenue; ``orders_count`` counts item lines."""
    return (
        item_lines(validated)
        .groupBy("product")
        .agg(
            F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"),
            F.coalesce(F.sum("units"), F.lit(0)).alias("units"),
            F.count(F.lit(1)).alias("orders_count"),
        )
        .orderBy(F.desc(F.round("revenue", 2)), "product")
        .limit(limit)
        .select(
            "product",
            money_double(F.col("revenue")).alias("revenue"),
            F.col("units").cast("double").alias("units_sold"),
            "orders_count",
        )
    )


def top_customers(validated: DataFrame, limit: int = 10) -> DataFrame:
    """Customers by money spent, each with the name on its first order.

    Sums are hash-aggregated without carrying names; the names of the few winners are looked up
    afterwards.
    """
    rows = business_rows(validated)
    winners = (
        rows.groupBy("customer_id")
        .agg(money_sum("total_amount").alias("total"), F.count(F.lit(1)).alias("orders_count"))
        .orderBy(F.desc("total"), "customer_id")
        .limit(limit)
    )
    few = F.broadcast(winners) if limit <= BROADCAST_TOP else winners
    first_order = F.struct("order_date", "order_id")
    return (
        rows.select("customer_id", "customer_name", "order_date", "order_id")
        .join(few, "customer_id")
        .groupBy("customer_id", "total", "orders_count")
        .agg(F.min_by("customer_name", first_order).alias("customer_name"))
        .orderBy(F.desc("total"), "customer_id")
        .select(
            "customer_id",
            "customer_name",
            money_double(F.col("total")).alias("total_spent"),
            "orders_count",
        )
    )


def sales_by_period(validated: DataFrame, granularity: str = "month") -> DataFrame:
    """Sales per month, or per day for any other granularity, oldest first."""
    length = 7 if granularity == "month" else 10
    return (
        business_rows(validated)
        .groupBy(F.substring("order_date", 1, length).alias("period"))
        .agg(money_sum("total_amount").alias("total"), F.count(F.lit(1)).alias("orders_count"))
        .select("period", money_double(F.col("total")).alias("total_sales"), "orders_count")
        .orderBy("period")
    )


def orders_status_distribution(validated: DataFrame) -> DataFrame:
    """Orders per status and their share; the grand total is one scalar, not a window."""
    grouped = (
        business_rows(validated).groupBy("status").agg(F.count(F.lit(1)).alias("orders_count"))
    )
    total = grouped.agg(F.sum("orders_count").alias("n")).scalar()
    return grouped.select(
        "status", "orders_count", percent(F.col("orders_count"), total, 2).alias("percentage")
    ).orderBy(F.desc("orders_count"), "status")


@dataclass(frozen=True)
class Report:
    build: Callable[..., DataFrame]
    description: str
    example: Params = field(default_factory=dict)


REPORTS = {
    "sales_by_city": Report(
        sales_by_city, "Sales, orders and average order value per city.", {"limit": 20}
    ),
    "top_products": Report(top_products, "Products by revenue of their item lines.", {"limit": 10}),
    "top_customers": Report(top_customers, "Customers by money spent.", {"limit": 10}),
    "sales_by_period": Report(
        sales_by_period, "Sales and orders per month or day.", {"granularity": "month"}
    ),
    "orders_status_distribution": Report(
        orders_status_distribution, "Orders per status and their share in percent."
    ),
}


def list_reports() -> dict[str, dict[str, object]]:
    return {
        name: {"description": spec.description, "example_params": spec.example}
        for name, spec in REPORTS.items()
    }


def run_report(validated: DataFrame, name: str, params: Params | None = None) -> DataFrame:
    return REPORTS[name].build(validated, **(params or {}))

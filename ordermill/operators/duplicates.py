"""Rules that look at other rows of the same order id: conflicts and last-row-wins.

One order id may hold a large share of a run, so nothing here sorts all rows of an id in one
task. Rows are taken in file order; a *block* is one order id's rows within one input split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.sources.order_csv import ROW_BLOCK, ROW_ORDER


def conflicting_rows(ruled: DataFrame, block_rows: int = ROW_BLOCK) -> DataFrame:
    """Lineage of the rows whose (customer, total) differs from the row before of their id.

    1. Partial aggregation finds the ids with more than one fingerprint; only their rows go on.
    2. ``lag`` runs inside each block, whose size an input split bounds.
    3. The first row of a block is compared with the last fingerprint of the id's block before,
       taken from one summary row per block.

    Rows rejected for other reasons take part; rows without an order id never do.
    """
    rows = ruled.where(F.col("order_id").isNotNull()).select(
        "order_id",
        *ROW_ORDER,
        F.struct("customer_id", "total_amount").alias("mark"),
    )
    # Hashes have fixed-size buffers, so this aggregates by hashing and sorts nothing. Two of them make
    # 128 bits: different marks with equal pairs of hashes do not occur in practice.
    parts = [x for c in ("mark.customer_id", "mark.total_amount") for x in (F.col(c).isNull(), F.col(c))]
    hashes = {"h": F.xxhash64(*parts), "g": F.xxhash64(F.lit(1), *parts)}
    suspects = (
        rows.select("order_id", *[h.alias(n) for n, h in hashes.items()])
        .groupBy("order_id")
        .agg(*[f(n).alias(f"{f.__name__}_{n}") for n in hashes for f in (F.min, F.max)])
        .where("min_h <> max_h or min_g <> max_g")
        .select("order_id")
    )
    block = ["order_id", "file_source", "block"]
    rows = rows.join(suspects, "order_id", "left_semi").withColumn(
        "block", F.expr(f"number_row_source div {block_rows}")
    )
    within = Window.partitionBy(*block).orderBy("number_row_source")
    rows = rows.withColumn("before", F.lag("mark").over(within))
    follows = rows.where(
        F.col("before").isNotNull() & ~F.col("mark").eqNullSafe(F.col("before"))
    )
    by_id = Window.partitionBy("order_id").orderBy("file_source", "block")
    edges = (
        rows.groupBy(*block)
        .agg(
            F.min_by(F.struct("number_row_source", "mark"), "number_row_source").alias("first"),
            F.max_by("mark", "number_row_source").alias("last"),
        )
        .withColumn("before", F.lag("last").over(by_id))
        .where(F.col("before").isNotNull() & ~F.col("first.mark").eqNullSafe(F.col("before")))
        .select("file_source", F.col("first.number_row_source").alias("number_row_source"))
    )
    return follows.select(*ROW_ORDER).unionByName(edges.select(*ROW_ORDER))


def repeated_last(accepted_rows: DataFrame) -> DataFrame:
    """Lineage of the last accepted row of every order id that has several, and how many rows state it.

    Only ids and lineage are shuffled, and of ids with one row nothing but a count.
    """
    keys = accepted_rows.select("order_id", *ROW_ORDER)
    repeated = (
        keys.groupBy(F.col("order_id").alias("repeated_id")).agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("repeated_id")
    )
    rows = keys.join(repeated, F.col("order_id").eqNullSafe(F.col("repeated_id")), "left_semi")
    return (
        rows.groupBy("order_id", *ROW_ORDER).agg(F.count(F.lit(1)).alias("n"))
        .groupBy("order_id").agg(F.max(F.struct(*ROW_ORDER, "n")).alias("last"))
        .select("order_id", "last.*")
    )


def last_wins(accepted_rows: DataFrame, lasts: DataFrame | None = None, null_ids: bool = True) -> DataFrame:
    """The last accepted row of every order id.

    The rank filter is pushed before the shuffle, so each map task sends one row per id. With ``lasts``, the
    written result of :func:`repeated_last` in which no lineage occurs twice, whole rows are not shuffled
    as long as it can be broadcast; nor are rows dealt by id, if ``lasts`` holds no null id and that is told.
    """
    if lasts is not None:
        known = lasts.select(F.col("order_id").alias("last_id"), F.struct(*ROW_ORDER).alias("last"))
        same = F.col("order_id").eqNullSafe(F.col("last_id")) if null_ids else F.col("order_id") == F.col("last_id")
        joined = accepted_rows.join(known, same, "left")
        is_last = F.col("last").isNull() | (F.struct(*ROW_ORDER) == F.col("last"))
        return joined.where(is_last).drop("last_id", "last")
    newest_first = Window.partitionBy("order_id").orderBy(*[F.desc(c) for c in ROW_ORDER])
    return (
        accepted_rows.withColumn("rank", F.row_number().over(newest_first))
        .where(F.col("rank") == 1)
        .drop("rank")
    )

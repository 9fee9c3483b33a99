"""The gold order facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Order status codes of the source.
STATUS_WORDS = {"F": "delivered", "O": "confirmed", "P": "pending"}


def order_facts(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per order with item count, subtotal, tax, total and the time of the last change.

    `orders`: order_id, customer_id, status, created_at; `lines`: order_id, price, discount, tax (decimals)
    and changed_at, already de-duplicated. Lines are summed per order before the join; an order without
    lines keeps zero amounts. Amounts are exact until the final rounding to cents.
    """
    net = F.col("price") * (F.lit(1) - F.col("discount"))
    sums = lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum(net).alias("net"),
        F.sum(net * F.col("tax")).alias("tax"),
        F.max("changed_at").alias("updated_at"),
    )
    money = lambda c: F.coalesce(c, F.lit(0)).cast("decimal(18,2)")
    status = F.create_map(*[F.lit(x) for pair in STATUS_WORDS.items() for x in pair])
    return orders.join(sums, "order_id", "left").select(
        "order_id",
        "customer_id",
        F.coalesce(F.try_element_at(status, "status"), F.lower("status")).alias("status"),
        F.coalesce("item_count", F.lit(0)).cast("int").alias("item_count"),
        money(F.col("net")).alias("subtotal"),
        money(F.col("tax")).alias("tax"),
        money(F.col("net") + F.col("tax")).alias("total"),
        "created_at",
        F.coalesce("updated_at", "created_at").alias("updated_at"),
    )

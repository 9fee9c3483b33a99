"""The gold customer summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlake.functions.expressions import timestamp_literal
from pactlake.operators.medallion import segment


def customer_summary(customers: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    """One row per customer as of a day: order count, spend, first and last order, segment.

    `customers`: customer_id, full_name, country_code and anything else to carry along;
    `orders`: customer_id, total (decimal), created_at. Orders after `as_of` are not counted.

    Orders are reduced to one row per customer before the join, with a partial aggregate ahead of the
    shuffle, so a customer with very many orders is one row when the join sees it.
    """
    moment = timestamp_literal(as_of)
    spent = (
        orders.where(F.col("created_at") <= moment)
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("total").cast("decimal(18,2)").alias("total_spend"),
            F.min("created_at").alias("first_order_at"),
            F.max("created_at").alias("last_order_at"),
        )
    )
    joined = customers.join(spent, "customer_id", "left")
    return joined.withColumns(
        {
            "total_orders": F.coalesce("total_orders", F.lit(0)),
            "total_spend": F.coalesce("total_spend", F.lit(0).cast("decimal(18,2)")),
            "customer_segment": segment(
                F.coalesce("total_spend", F.lit(0)), F.col("first_order_at"), F.col("last_order_at"), moment
            ),
            "as_of_date": moment.cast("date"),
        }
    )

"""Registration of queries and the inputs they share."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from pactlake.contract import Product, load_product

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CONTRACTS = Path(__file__).parent.parent / "contracts"
AS_OF = "2001-08-02 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@cache
def contract(name: str) -> Product:
    return load_product(CONTRACTS / f"{name}.yml")


def private_copy(product: Product) -> Product:
    """The product under a name of its own, so that runs do not meet in the catalog."""
    return replace(product, name=f"{product.name}_{uuid.uuid4().hex[:12]}")

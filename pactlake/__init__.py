"""Data contracts executed as Spark jobs."""

from pactlake.contract import Column, ContractError, Partition, Product, Rule, Table, load_product, parse_product

__all__ = ["Column", "ContractError", "Partition", "Product", "Rule", "Table", "load_product", "parse_product"]

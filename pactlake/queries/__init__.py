"""The registered queries, each next to the SQL that must give the same rows."""

from pactlake.queries import (  # noqa: F401
    deployments, governance, layout, medallion, quality, schema, sla, sources, streaming,
)
from pactlake.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

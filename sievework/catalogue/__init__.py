"""Every operator as a query over the driver tables, with the SQL that must give the same rows."""

from sievework.catalogue import (  # noqa: F401
    check_queries,
    contract_queries,
    gate_queries,
    landing_queries,
    storage_queries,
    version_queries,
    warehouse_queries,
)
from sievework.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

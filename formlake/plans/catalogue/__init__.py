"""Every operator as a named query over the given tables, with its SQL twin."""

from formlake.plans.catalogue import (  # noqa: F401  (importing registers the queries)
    audit,
    dictionary,
    labels,
    records,
    streams,
    transfer,
    types,
)
from formlake.plans.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""All registered queries; importing the modules fills the registry."""

from sluice.plans import (  # noqa: F401
    ingest_queries,
    load_queries,
    model_queries,
    neighbor_queries,
    text_queries,
)
from sluice.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

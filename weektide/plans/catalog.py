"""All named queries."""

from weektide.plans import (  # noqa: F401  (importing registers)
    catalog_evaluation,
    catalog_kpis,
    catalog_models,
    catalog_quality,
    catalog_series,
    catalog_storage,
)
from weektide.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

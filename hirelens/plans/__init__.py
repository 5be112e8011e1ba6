"""Registered queries: importing this package fills the registry."""

from hirelens.plans import gold_queries  # noqa: F401
from hirelens.plans import report_queries  # noqa: F401
from hirelens.plans import etl_queries  # noqa: F401
from hirelens.plans import merge_queries  # noqa: F401
from hirelens.plans import ml_queries  # noqa: F401
from hirelens.plans import dashboard_queries  # noqa: F401
from hirelens.plans import case_queries  # noqa: F401
from hirelens.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]

"""All registered queries."""

from fellwalk.plans import raster, regional, tabular  # noqa: F401  they register their queries
from fellwalk.plans.registry import JOBS

__all__ = ["JOBS"]

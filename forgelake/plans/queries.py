"""All registered queries."""

from forgelake.plans import queries_apply, queries_builders, queries_jobs, queries_relational, queries_scalars  # noqa: F401
from forgelake.plans.catalog import CATALOG, checks, runners

__all__ = ["CATALOG", "checks", "runners"]

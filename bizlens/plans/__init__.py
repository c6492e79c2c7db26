"""Reports over the given tables: every operator of the package on whole tables."""

from bizlens.plans.registry import REPORTS
from bizlens.plans import (  # noqa: F401  (importing a module registers its reports)
    customers, learning, quality, sales, storage, summaries, timeline,
)

__all__ = ["REPORTS"]

"""Business analytics as DataFrame operators for PySpark."""

from bizlens.operators import (
    basket, churn, clean, cohort, evaluation, features, forest, joins, linear, models, periods, prices, quality, rfm, sales,
    scale, segment, summary,
)
from bizlens.session import build_session, checkpoint_folder
from bizlens.sources import readers, sinks

__all__ = [
    "basket", "build_session", "checkpoint_folder", "churn", "clean", "cohort", "evaluation", "features", "forest", "joins",
    "linear", "models", "periods", "prices", "quality", "readers", "rfm", "sales", "scale", "segment", "sinks", "summary",
]

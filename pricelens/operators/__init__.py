"""Reusable DataFrame operators."""

from pricelens.operators.dimension import join_dimension  # noqa: F401
from pricelens.operators.ordered import exact_median, latest_by, rank_top_k, skew_safe_lag  # noqa: F401

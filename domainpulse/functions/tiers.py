"""Tier, severity and driver expressions, all built-in column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from domainpulse.config import REFERENCE_BANDS, TIER_LABELS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band_tier(score: Column | str, mode: str = "reference") -> Column:
    """Score band -> tier label.

    ``reference``: inclusive integer bands checked in order, anything that
    matches none (25.1-25.9, 50.1-50.9, 75.1-75.9, negatives, null) is LOW.
    ``contiguous``: cuts at >75, >50, >25.
    """
    s = _col(score)
    if mode == "reference":
        expr = None
        for low, high, tier in REFERENCE_BANDS:
            cond = (s >= low) & (s <= high)
            expr = F.when(cond, F.lit(tier)) if expr is None else expr.when(cond, F.lit(tier))
        return expr.otherwise(F.lit("LOW"))
    if mode == "contiguous":
        return (
            F.when(s > 75, F.lit("CRITICAL"))
            .when(s > 50, F.lit("HIGH"))
            .when(s > 25, F.lit("MEDIUM"))
            .otherwise(F.lit("LOW"))
        )
    raise ValueError(f"unknown band_mode {mode!r}")


def tier_rank(tier: Column | str) -> Column:
    """LOW=0 .. CRITICAL=3; unknown or null labels rank 0."""
    t = _col(tier)
    expr = None
    for rank, label in enumerate(TIER_LABELS):
        expr = F.when(t == label, F.lit(rank)) if expr is None else expr.when(t == label, F.lit(rank))
    return expr.otherwise(F.lit(0))


def reconcile_tier(score_tier: Column | str, cluster_tier: Column | str) -> Column:
    """Cluster tier wins only when it ranks at least two above the score tier."""
    st, ct = _col(score_tier), _col(cluster_tier)
    return F.when(tier_rank(ct) > tier_rank(st) + 1, ct).otherwise(st)


def top_driver(contributions: Mapping[str, Column]) -> Column:
    """Name of the largest contribution; ties go to the earliest name."""
    best = F.greatest(*contributions.values())
    expr = None
    for name, c in contributions.items():
        expr = F.when(c == best, F.lit(name)) if expr is None else expr.when(c == best, F.lit(name))
    return expr.otherwise(F.lit(next(iter(contributions))))


def severity_label(breach_count: Column | str) -> Column:
    """3 breaches -> CRITICAL, 2 -> HIGH, anything else -> MEDIUM."""
    b = _col(breach_count)
    return F.when(b == 3, F.lit("CRITICAL")).when(b == 2, F.lit("HIGH")).otherwise(F.lit("MEDIUM"))

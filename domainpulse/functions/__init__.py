"""Column-expression helpers (pure JVM expressions, no Python UDFs)."""

from domainpulse.functions.rounding import round_half_up, round_half_even  # noqa: F401
from domainpulse.functions.tiers import (  # noqa: F401
    band_tier, reconcile_tier, tier_rank, top_driver, severity_label,
)

"""Feature matrix: guard, rename, median imputation, standardisation.

All per-column statistics are global aggregates (partial + final, one
row); the one-row result is broadcast back, so no step shuffles the
feature rows themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domainpulse.config import FEATURES
from domainpulse.functions.missing import known
from domainpulse.operators.ordinal import exact_medians

SOURCE = {"avg_update_lag": "avg_update_lag_hrs"}


def null_counts(kpi: DataFrame) -> DataFrame:
    """One row: total rows and nulls per feature source column."""
    return kpi.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(known(SOURCE.get(c, c)).isNull()).alias(f"nulls_{c}") for c in FEATURES],
    )


def guard_features(kpi: DataFrame) -> dict[str, int]:
    """Raise on an empty input, a missing or an all-null feature column.

    Returns the null count per feature (partial nulls are imputed later).
    """
    missing = [SOURCE.get(c, c) for c in FEATURES if SOURCE.get(c, c) not in kpi.columns]
    if missing:
        raise ValueError(f"expected feature columns not found: {missing}")
    row = null_counts(kpi).first()
    n = row["n_rows"]
    if not n:
        raise ValueError("KPI summary has no rows; nothing to score")
    nulls = {c: row[f"nulls_{c}"] for c in FEATURES}
    all_null = [c for c, k in nulls.items() if k == n]
    if all_null:
        raise ValueError(f"feature columns entirely null, cannot scale: {all_null}")
    return nulls


def raw_features(kpi: DataFrame) -> DataFrame:
    """domain_id + the four features as doubles (lag renamed)."""
    return kpi.select("domain_id", *[known(SOURCE.get(c, c)).alias(c) for c in FEATURES])


def impute_median(features: DataFrame, nulls: dict[str, int] | None = None) -> DataFrame:
    """Fill nulls with the column's interpolated median (only where needed, all columns in one pass)."""
    if nulls is None:
        row = features.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in FEATURES]).first()
        nulls = row.asDict()
    gaps = [c for c in FEATURES if nulls.get(c)]
    if not gaps:
        return features
    medians = exact_medians(features, gaps)
    return features.withColumns({c: F.coalesce(F.col(c), F.lit(medians[c])) for c in gaps})


def build_features(kpi: DataFrame) -> DataFrame:
    """Guard, rename and impute: the raw feature matrix."""
    nulls = guard_features(kpi)
    return impute_median(raw_features(kpi), nulls)


def scaler_stats(features: DataFrame) -> DataFrame:
    """One row: mean and population std per feature."""
    return features.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in FEATURES],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in FEATURES],
    )


def standardise(features: DataFrame, keep: tuple[str, ...] = ("domain_id",)) -> DataFrame:
    """z = (x - mean) / population std; zero-variance columns become 0.

    Mean and std are uncorrelated scalar subqueries over one aggregate
    (Catalyst merges them into a single pass), so the feature rows are
    never joined or shuffled.
    """
    stats = scaler_stats(features)
    cols = []
    for c in FEATURES:
        mean = stats.select(f"mean_{c}").scalar()
        std = stats.select(f"std_{c}").scalar()
        cols.append(F.when(std == 0, F.lit(0.0)).otherwise((F.col(c) - mean) / std).alias(f"{c}_scaled"))
    return features.select(*keep, *cols)


def scaler_params(features: DataFrame) -> DataFrame:
    """Mean and std as data: one row per feature."""
    stats = scaler_stats(features)
    pairs = ", ".join(f"'{c}', mean_{c}, std_{c}" for c in FEATURES)
    return stats.selectExpr(f"stack({len(FEATURES)}, {pairs}) AS (feature, mean, std)")


SCALED = tuple(f"{c}_scaled" for c in FEATURES)

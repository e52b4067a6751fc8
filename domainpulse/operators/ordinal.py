"""Global order statistics without a single-task window.

A window with ``orderBy`` and no ``partitionBy`` moves every row into one
task.  These helpers keep the work distributed instead:

1. collapse the input to distinct order keys with a row count where that
   applies (partial aggregation, so a hot key costs one row per map task);
2. split the key space into ordered buckets at sampled boundary keys (the
   boundaries are literals, so a key's bucket is a pure function of the
   key: recomputation after executor loss gives the same buckets);
3. take running counts inside each bucket (a window partitioned by bucket)
   and add the totals of all earlier buckets (one row per bucket,
   broadcast).

Boundaries only balance the buckets; any boundaries give the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from domainpulse.session import cut_lineage

OrderSpec = tuple[str, bool, bool]  # (column, descending, nulls_last)


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))


def _normalised(order: list[OrderSpec]) -> list[Column]:
    """Columns whose ascending, null-free lexicographic order is ``order``.

    Each column contributes (null flag, value); descending numeric columns
    are negated.
    """
    parts = []
    for c, desc, nulls_last in order:
        parts.append(F.col(c).isNull() if nulls_last else F.col(c).isNotNull())
        parts.append(-F.col(c) if desc else F.col(c))
    return parts


def _bucket(keys: DataFrame, order: list[OrderSpec], buckets: int) -> Column:
    """Bucket id from up to ``buckets - 1`` sampled boundary keys (bounded collect)."""
    norm = _normalised(order)
    n = keys.count()
    if n == 0 or buckets <= 1:
        return F.lit(0)
    frac = min(1.0, 20.0 * buckets / n)
    sample = keys.sample(fraction=frac, seed=29).select(*[c.alias(f"_n{i}") for i, c in enumerate(norm)])
    rows = sorted(tuple(r) for r in sample.collect())  # about 20 keys per bucket
    if not rows:  # a small sample may come back empty: halve the keys at the middle of their range
        named = F.struct(*[c.alias(f"_n{i}") for i, c in enumerate(norm)])
        rows = [tuple(v) for v in keys.agg(F.min(named).alias("lo"), F.max(named).alias("hi")).first()]
    step = max(1, len(rows) // buckets)
    bounds = sorted(set(rows[i] for i in range(step, len(rows), step)))
    types = [f.dataType for f in sample.schema.fields]
    key = F.struct(*[c.alias(f"_n{i}") for i, c in enumerate(norm)])
    lits = [F.struct(*[F.lit(v).cast(t).alias(f"_n{i}") for i, (v, t) in enumerate(zip(b, types))])
            for b in bounds]

    def search(lo: int, hi: int) -> Column:
        # bucket = number of boundaries <= key, found by binary search over the
        # sorted boundaries: log2(buckets) comparisons per row, not one per boundary
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        return F.when(key >= lits[mid - 1], search(mid, hi)).otherwise(search(lo, mid - 1))

    return search(0, len(lits))


def rows_before(keys: DataFrame, order: list[OrderSpec], weight: str, partitions: int | None = None) -> DataFrame:
    """Add ``rows_before``: total ``weight`` of all rows strictly earlier in ``order``.

    ``keys`` must be unique on the order (e.g. the output of a group-by).
    """
    bucketed = keys.withColumn("_b", _bucket(keys, order, _partitions(keys, partitions)))
    norm = _normalised(order)
    in_bucket = Window.partitionBy("_b").orderBy(*norm).rowsBetween(Window.unboundedPreceding, -1)
    local = bucketed.withColumn("_local_before", F.coalesce(F.sum(weight).over(in_bucket), F.lit(0)))
    # One row per bucket: bounded by the bucket count.
    totals = bucketed.groupBy("_b").agg(F.sum(weight).alias("_total"))
    offsets = totals.select(
        "_b",
        F.coalesce(
            F.sum("_total").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_offset"),
    )
    return (
        local.join(F.broadcast(offsets), "_b")
        .withColumn("rows_before", (F.col("_local_before") + F.col("_offset")).cast("long"))
        .drop("_b", "_local_before", "_offset")
    )


def rank_by(df: DataFrame, col: str, descending: bool = True, out: str = "rank",
            partitions: int | None = None) -> DataFrame:
    """SQL ``RANK() OVER (ORDER BY col [DESC])`` (nulls last), distributed."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_w"))
    ranks = rows_before(counts, [(col, descending, True)], "_w", partitions).select(
        F.col(col).alias("_rk"), (F.col("rows_before") + 1).alias(out)
    )
    return df.join(ranks, df[col].eqNullSafe(ranks["_rk"])).drop("_rk")


def number_rows(df: DataFrame, order: list[str], out: str = "row_id", start: int = 1,
                partitions: int | None = None) -> DataFrame:
    """Dense ids ``start, start+1, ...`` in ``order`` (must be a unique order)."""
    keyed = df.withColumn("_w", F.lit(1))
    numbered = rows_before(keyed, [(c, False, False) for c in order], "_w", partitions)
    return numbered.withColumn(out, F.col("rows_before") + F.lit(start)).drop("_w", "rows_before")


def exact_medians(df: DataFrame, cols: Sequence[str], partitions: int | None = None) -> dict[str, float | None]:
    """Interpolated medians of the non-null values of several columns (pandas ``median``), in one pass.

    All columns are turned into (column, value, count) rows and numbered together
    in the order of column and value, so the number of jobs does not
    depend on the number of columns.  Per column, one total and at most two
    middle values reach the driver.  A column without values has no median.
    """
    cols = list(cols)
    named = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)])
    values = df.select(F.explode(named).alias("p")).select("p.c", "p.v").where(F.col("v").isNotNull())
    counts = cut_lineage(values.groupBy("c", "v").agg(F.count(F.lit(1)).alias("_w")))
    held = {r["c"]: r["n"] for r in counts.groupBy("c").agg(F.sum("_w").alias("n")).collect()}  # one row per column
    if not held:
        return dict.fromkeys(cols)
    middle, start = [], 0
    for c in sorted(held):  # the order in which the columns are numbered
        n = held[c]
        middle += [(c, start + (n - 1) // 2), (c, start + n // 2)]
        start += n
    pos = rows_before(counts, [("c", False, False), ("v", False, False)], "_w", partitions)
    wanted = F.filter(F.array(*[F.lit(p) for _, p in middle]),
                      lambda p: (F.col("rows_before") <= p) & (F.col("rows_before") + F.col("_w") > p))
    picked = {r["p"]: r["v"] for r in pos.select("v", F.explode(F.array_distinct(wanted)).alias("p")).collect()}
    out: dict[str, float | None] = dict.fromkeys(cols)
    for (c, lo), (_, hi) in zip(middle[::2], middle[1::2]):
        out[cols[c]] = picked[lo] + (picked[hi] - picked[lo]) / 2.0
    return out


def exact_median(df: DataFrame, col: str, partitions: int | None = None) -> float | None:
    """Interpolated median of the non-null values of one column."""
    return exact_medians(df, [col], partitions)[col]

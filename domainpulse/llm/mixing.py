"""Mix sources to target weights (DataFrame operations only).

1. one pass sums words per source (partial aggregation, so a hot source
   costs one row per task);
2. the source table, one row per source, gets a target by weight, capped
   at ``limit`` times the source's size; what a cap cuts off is shared
   among the others by weight until none is above its cap;
3. every document is emitted floor(rate) times plus once more if a draw
   from the digest of its seed and id falls below rate - floor(rate).

The draw depends on the seed and the document's id alone: reruns, other
partitionings and recomputed tasks give the same copies.  Rows that share an
id (or a text, without one) would all go or all stay by one draw, far off the
target if they are many; so their draws also take their place in the input:
reruns over the same files agree, other layouts may choose others of them.

Defined results: a null text has size 0; null sources are one source,
last in order; rows without doc_id draw by their text; repeated rows are
separate rows with draws of their own; an empty table gives no rows; a source of
size 0 has target 0 and takes nothing; input columns named like the added
ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from domainpulse.llm.common import documents, hex_fraction, id_text, small, stored, without, word_count

#: Weights of the sources in order of their names, repeating (fixed values).
WEIGHTS = (5, 2, 1)
LIMIT = 3
SEED = "mix"
ADDED = ("size", "source_size", "target", "rate", "copies")


def source_targets(sized: DataFrame, source: str = "source", weights=WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """(source, source_size, target, rate), one row per source, from rows with ``size``."""
    totals = sized.groupBy(F.col(source).alias("_source")).agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("_place") % len(weights) + 1)
    weighed = (
        totals.withColumn("_place", F.row_number().over(by_name) - 1)
        .withColumn("_w", weight.cast("long"))
        .withColumn("_cap", F.col("source_size") * F.lit(limit))
    )
    # Sources by the level at which they reach their cap.  At the first source whose cap is not
    # passed, the earlier ones stand at their caps and the rest share what is left by weight.
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("_cap") / F.col("_w"), "_place")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / (
        F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0)))
    levelled = weighed.withColumn("_level", level).withColumn(
        "_common",
        F.first(F.when(F.col("_level") <= F.col("_cap") / F.col("_w"), F.col("_level")), ignorenulls=True).over(
            by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    )
    share = F.col("_common") * F.col("_w")
    target = F.when(F.col("_cap") / F.col("_w") < F.col("_common"), F.col("_cap").cast("double")).otherwise(
        F.least(share, F.col("_cap").cast("double")))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return levelled.select("_source", "source_size", target.alias("target"), rate.alias("rate"))


def plan_mix(docs: DataFrame, weights=WEIGHTS, limit: int = LIMIT, seed: str = SEED) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target, rate and the copies that the mix takes."""
    sized = without(docs, *ADDED).withColumn("size", word_count()).withColumn("_key", id_text()).withColumn(
        "_row", F.monotonically_increasing_id())
    shared = sized.groupBy(F.col("_key").alias("_shared")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_shared")
    shared = small(stored(shared, "mix-shared-ids"))
    targets = small(stored(source_targets(sized, "source", weights, limit), "mix-sources"))
    place = F.when(F.col("_shared").isNull(), F.lit("")).otherwise(F.concat(F.lit(":"), F.col("_row").cast("string")))
    draw = hex_fraction(F.md5(F.concat(F.lit(f"{seed}:"), F.col("_key"), place)))
    whole = F.floor("rate")
    return (
        sized.join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .join(shared, F.col("_key") == F.col("_shared"), "left")
        .withColumn("copies", (whole + (draw < F.col("rate") - whole).cast("long")).cast("long"))
        .drop("_source", "_key", "_row", "_shared")
    )


def emit_mix(planned: DataFrame, drop: tuple[str, ...] = ADDED) -> DataFrame:
    """The mix itself: each planned row once per copy."""
    repeats = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    return planned.where("copies > 0").withColumn("_copy", F.explode(repeats)).drop("_copy", *drop)


def mixed(docs: DataFrame) -> DataFrame:
    """The mix of ``docs`` with their own columns only."""
    packed = docs.select(F.struct("*").alias("row"), "doc_id", "text", "source")
    return emit_mix(plan_mix(packed)).select("row.*")


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    planned = plan_mix(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return planned.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, text,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
placed AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place FROM totals),
weighed AS (SELECT *, ([5, 2, 1])[(place % 3 + 1)::INT]::BIGINT AS w, source_size * 3 AS cap FROM placed),
levelled AS (
  SELECT *, cap::DOUBLE / w AS own,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE
         / (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::DOUBLE AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap::DOUBLE / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
common AS (SELECT arg_min(level, (own, place)) AS c FROM levelled WHERE level <= own),
targets AS (
  SELECT source, source_size,
         CASE WHEN own < c THEN cap::DOUBLE ELSE least(c * w, cap::DOUBLE) END AS target
  FROM levelled, common),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets),
drawn AS (
  SELECT d.*, r.source_size, r.target, r.rate,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, '')))), 1, 13))::BIGINT
         / 4503599627370496.0::DOUBLE AS u
  FROM sized d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM drawn
"""

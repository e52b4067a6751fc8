"""Sharding by sampled splitters (DataFrame operations only).

Records are ordered by a key: digest of the text, then digest of the id,
both as hex, so equal texts stand together and a hot text can still be
divided.  Then

1. a sample is drawn in which a row's chance grows with its size, and its
   quantiles become range boundaries (only the sample reaches the driver:
   ``OVERSAMPLE`` keys per range);
2. every row finds its range by a two-level search over the boundaries;
   ranges above twice the mean size are sampled again and subdivided, until
   no sample parts them any more;
3. running sizes inside a range (a window partitioned by range) plus the
   totals of the ranges before give each row its exact place, and the place
   gives its shard: shard i holds the i-th equal part of all bytes.

The boundaries only spread the work; the shards depend on the key order
alone.  A group of equal texts of at most 1/``GROUP_PART`` of a shard stays
in one shard (by the group's middle), also where boundaries divide it: the
size and start of such a text come from an aggregate over all its rows.  A
larger group is divided by rows, as it would leave the shards unequal.

Law ``bytes``: sizes are near equal; a shard is off by at most half a row,
or half such a group, at each end.

Defined results: null text has 0 bytes (size 1) and the digest of the
empty text; null ids come first within a text; repeated rows get separate
slots; an empty table gives no rows; input columns named like the added
ones are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from domainpulse.llm.common import documents, id_text, small, stored, text_or_empty, without

SHARDS = 16
#: Sampled keys per range, ranges per shard, and the bytes above which there are more ranges.
OVERSAMPLE, RANGES_PER_SHARD, RANGE_BYTES = 16, 8, 1 << 31
GROUP_PART = 10
ADDED = ("size", "law", "shard", "slot", "grown_shard")
PREFIX = 15  # hex digits of each digest in the range key


def _keyed(docs: DataFrame) -> DataFrame:
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.lit(1)
    return (
        without(docs, *ADDED).withColumn("size", size)
        .withColumn("_text_key", F.md5(text_or_empty()))
        .withColumn("_id_key", F.md5(id_text()))
        .withColumn("_key", F.concat(F.substring("_text_key", 1, PREFIX), F.substring("_id_key", 1, PREFIX)))
    )


def _strings(values: list[str]) -> Column:
    """An array of strings as one literal, however many there are."""
    return F.split(F.lit(",".join(values)), ",") if values else F.array().cast("array<string>")


def _range_of(key: Column, bounds: list[str]) -> Column:
    """How many of the sorted boundaries are at most ``key``: a search among every step-th, then inside one step."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    passed = F.size(F.filter(_strings(bounds[step - 1::step]), lambda b: b <= key))
    inside = F.slice(_strings(bounds), passed * step + 1, F.lit(max(1, step - 1)))
    return passed * step + (F.size(F.filter(inside, lambda b: b <= key)) if step > 1 else F.lit(0))


def _boundaries(keys: list[tuple[str, float]], ranges: int) -> list[str]:
    """Quantiles of weighted sample keys.

    A text met by one boundary only is not divided: the boundary moves to the text's start.
    """
    keys = sorted(keys)
    total, seen, found = sum(w for _, w in keys), 0.0, []
    for key, w in keys:
        if seen >= (len(found) + 1) * total / ranges:
            found.append(key)
            while seen >= (len(found) + 1) * total / ranges and len(found) < ranges - 1:
                found.append(key)
        seen += w
    texts = [b[:PREFIX] for b in found]
    return sorted({b if texts.count(t) > 1 else t for b, t in zip(found, texts)})


def _sample(keyed: DataFrame, total: int, wanted: int, seed: int) -> list[tuple[str, float]]:
    """About ``wanted`` keys, drawn by size, each with the weight that its chance leaves it."""
    chance = F.col("size") * F.lit(wanted / max(total, 1))
    draw = F.pmod(F.xxhash64("_key", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = keyed.where(draw < chance).select("_key", F.greatest(chance, F.lit(1.0)).alias("w")).collect()
    return [(r["_key"], r["w"]) for r in rows]


def splitters(keyed: DataFrame, shards: int) -> tuple[list[str], list[tuple[int, int]]]:
    """Range boundaries, and (bytes, rows) of every range."""
    total = keyed.agg(F.sum("size")).first()[0] or 0
    ranges = max(shards * RANGES_PER_SHARD, math.ceil(total / RANGE_BYTES))
    bounds = _boundaries(_sample(keyed, total, ranges * OVERSAMPLE, 1), ranges) if total else []
    again = 0
    while True:
        rows = keyed.groupBy(_range_of(F.col("_key"), bounds).alias("_range")).agg(
            F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"), F.max("size").alias("m"),
            F.min("_key").alias("lo"), F.max("_key").alias("hi")).collect()
        found = {r["_range"]: (r["b"], r["n"]) for r in rows}
        mean = total / ranges
        over = {r["_range"]: r["b"] for r in rows if r["b"] > 2 * mean and r["lo"] < r["hi"]}
        sizes = [found.get(i, (0, 0)) for i in range(len(bounds) + 1)]
        if not over:
            return bounds, sizes
        again += 1
        inside = keyed.withColumn("_range", _range_of(F.col("_key"), bounds)).where(F.col("_range").isin(*over))
        more = _sample(inside, sum(over.values()), OVERSAMPLE * (again + 1) * len(over) * 4, again + 1)
        added = set()
        edges = [""] + bounds + ["g"]
        for k, b in over.items():
            own = [(key, w) for key, w in more if edges[k] <= key < edges[k + 1]]
            added.update(_boundaries(own, max(2, math.ceil(b / mean))))
        finer = sorted({*bounds, *added})
        if len(finer) == len(bounds):
            return bounds, sizes
        bounds = finer


def _placed(keyed: DataFrame, bounds: list[str], sizes: list[tuple[int, int]], shards: int) -> DataFrame:
    """``keyed`` with the shard and the global row number in key order."""
    total = sum(b for b, _ in sizes)
    bytes_before, rows_before, b, n = [], [], 0, 0
    for own_b, own_n in sizes:
        bytes_before.append(b)
        rows_before.append(n)
        b, n = b + own_b, n + own_n
    split = sorted({x[:PREFIX] for x in bounds if len(x) > PREFIX})
    order = ["_text_key", "_id_key", F.col("doc_id").asc_nulls_first(), "size"]
    in_range = Window.partitionBy("_range").orderBy(*order)
    of_text = Window.partitionBy("_range", "_text_key")
    at = lambda values: F.element_at(F.split(F.lit(",".join(map(str, values))), ","), F.col("_range") + 1).cast("long")
    placed = (
        keyed.withColumn("_range", _range_of(F.col("_key"), bounds))
        .withColumn("_start", F.coalesce(
            F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + at(bytes_before))
        .withColumn("_row", F.row_number().over(in_range) + at(rows_before))
    )
    group, start = F.sum("size").over(of_text), F.min("_start").over(of_text)
    if split:
        divided = F.array_contains(_strings(split), F.substring("_text_key", 1, PREFIX))
        sums = placed.where(divided).groupBy(F.col("_text_key").alias("_divided")).agg(
            F.sum("size").alias("_all"), F.min("_start").alias("_first"))
        # at most one row per boundary
        placed = placed.join(small(stored(sums, "shard-divided")), F.col("_text_key") == F.col("_divided"), "left")
        group, start = F.coalesce("_all", group), F.coalesce("_first", start)
    placed = placed.withColumn("_group", group).withColumn("_group_start", start)
    whole = F.col("_group") * F.lit(GROUP_PART * shards) <= F.lit(total)
    middle = F.when(whole, F.col("_group_start") * 2 + F.col("_group")).otherwise(F.col("_start") * 2 + F.col("size"))
    shard = F.expr(f"cast(least(_middle * {shards} div {2 * max(total, 1)}, {shards - 1}) as int)")
    return placed.withColumn("_middle", middle).withColumn("shard", shard)


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every row of ``docs`` with size, law, shard, slot and grown_shard (null under this law)."""
    keyed = _keyed(docs)
    # written once: the passes below then read a few bytes per row instead of the texts
    slim = stored(keyed.select("doc_id", "size", "_text_key", "_id_key", "_key"), "shard-keys")
    bounds, sizes = splitters(slim, shards)
    first = {r["shard"]: r["r"] for r in _placed(slim, bounds, sizes, shards).groupBy("shard").agg(
        F.min("_row").alias("r")).collect()}  # at most one row per shard
    starts = F.array(*[F.lit(first.get(i, 1)).cast("long") for i in range(shards)])
    return (
        _placed(keyed, bounds, sizes, shards)
        .withColumn("slot", F.col("_row") - F.element_at(starts, F.col("shard") + 1))
        .withColumn("law", F.lit("bytes"))
        .withColumn("grown_shard", F.lit(None).cast("int"))
        .drop("_text_key", "_id_key", "_key", "_range", "_start", "_row", "_group", "_group_start", "_middle", "_divided",
              "_all", "_first")
    )


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    sharded = shard_by_bytes(documents(spark, sf_dir).select("doc_id", "text"))
    return sharded.select(
        "doc_id", "size", F.crc32(text_or_empty()).cast("long").alias("text_crc32"), "law", "shard", "slot",
        "grown_shard")


OP1_SQL = r"""
WITH keyed AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT + 1 AS size, md5(coalesce(text, '')) AS tk,
         md5(coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, '')))) AS ik,
         hex(encode(coalesce(text, ''))) AS hx
  FROM documents),
placed AS (
  SELECT *, coalesce(sum(size) OVER (ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s,
         row_number() OVER ord AS r, sum(size) OVER (PARTITION BY tk)::BIGINT AS g, sum(size) OVER ()::BIGINT AS total
  FROM keyed WINDOW ord AS (ORDER BY tk, ik, doc_id NULLS FIRST, size)),
grouped AS (SELECT *, min(s) OVER (PARTITION BY tk) AS gs FROM placed),
sharded AS (
  SELECT *, least(((CASE WHEN g * 160 <= total THEN gs * 2 + g ELSE s * 2 + size END) * 16) // (2 * total), 15)::INT
    AS shard
  FROM grouped),
-- CRC-32 by nibbles: table entry i is i shifted right four times, each time folding the polynomial in
nibble AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce([i::UBIGINT, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS v
  FROM range(16) x(i)))
SELECT doc_id, size,
       xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(length(hx)),
         -- low nibble of each byte first
         lambda i: (strpos('0123456789ABCDEF', substr(hx, (i + 2 - 2 * (i % 2))::BIGINT, 1)) - 1)::UBIGINT)),
         lambda c, d: xor(c >> 4, t[(xor(c, d) & 15)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32,
       'bytes' AS law, shard, (r - min(r) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INT AS grown_shard
FROM sharded, nibble
"""

"""Hot keys: one key holding a third or more of all rows.

Results must stay whole and exact, and the operators must combine a hot key
before it is shuffled (partial aggregation) rather than move its rows into
one task.
"""

import datetime as dt
import random
import statistics

from pyspark.sql import functions as F

from domainpulse.operators import quality as dq
from domainpulse.operators.ordinal import exact_median, rank_by
from domainpulse.operators.profile import profile
from helpers import metrics


def _raw(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        dom = "HOT" if i % 2 == 0 else f"D{rnd.randint(0, 40)}"  # half of all rows on one domain
        ts = base + dt.timedelta(days=rnd.randint(0, 3), hours=rnd.randint(0, 23))
        rows.append((dom, ts, rnd.choice(["ok", "error"]), rnd.randint(0, 3)))
    return rows, spark.createDataFrame(rows, "dom string, ts timestamp_ntz, kind string, gaps int")


def test_profile_of_a_hot_domain_is_exact_and_partially_aggregated(spark):
    rows, raw = _raw(spark)
    out = profile(raw, domain_id=F.col("dom"), event_time=F.col("ts"), null_when=F.col("kind") == "error",
                  stale_when=F.hour("ts") < 12, update_lag=F.max(F.hour("ts")), missing_fields=F.sum("gaps"))
    got = {(r.domain_id, r.snapshot_date): r for r in out.collect()}
    want = {}
    for dom, ts, kind, gaps in rows:
        want.setdefault((dom, ts.date()), []).append((ts, kind, gaps))
    assert set(got) == set(want)
    for k, grp in want.items():
        r = got[k]
        assert r.total_records == len(grp)
        assert abs(r.null_rate - sum(kind == "error" for _, kind, _ in grp) / len(grp)) < 1e-12
        assert abs(r.stale_rate - sum(ts.hour < 12 for ts, _, _ in grp) / len(grp)) < 1e-12
        assert r.update_lag_hrs == max(ts.hour for ts, _, _ in grp)
        assert r.missing_fields == sum(g for _, _, g in grp)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # combined map-side, before the exchange


def test_order_statistics_with_a_value_holding_a_third(spark):
    rnd = random.Random(11)
    vals = [5.0] * 400 + [float(rnd.randint(0, 50)) for _ in range(800)]
    df = spark.createDataFrame([(f"D{i}", v) for i, v in enumerate(vals)], "id string, s double")
    assert exact_median(df, "s", partitions=4) == statistics.median(vals)
    got = {r.id: r["rank"] for r in rank_by(df, "s", partitions=4).collect()}
    ordered = sorted(vals, reverse=True)
    first = {}
    for i, v in enumerate(ordered):
        first.setdefault(v, i + 1)
    assert got == {f"D{i}": first[v] for i, v in enumerate(vals)}


def test_duplicate_check_on_a_hot_key_counts_every_copy(spark):
    m = metrics(spark, [("HOT", 0, 0.1, 0.1, 1.0, 0)] * 600 + [(f"D{i}", 0, 0.1, 0.1, 1.0, 0) for i in range(1200)])
    issue = dq.check_duplicate_keys(m).collect()
    assert len(issue) == 1 and issue[0].rows_affected == 600
    assert dq.duplicate_groups(m).count() == 1


def test_ordinal_buckets_are_ordered_for_any_bucket_count(spark):
    from domainpulse.operators.ordinal import _bucket

    rnd = random.Random(5)
    rows = [(f"D{i}", float(rnd.randint(0, 300)) if i % 17 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "id string, s double")
    df.createOrReplaceTempView("ordinal_t")
    want = {r.id: r.rk for r in spark.sql(
        "SELECT id, RANK() OVER (ORDER BY s DESC NULLS LAST) AS rk FROM ordinal_t").collect()}
    key = F.coalesce(-F.col("s"), F.lit(1e18))  # the order the buckets follow (desc, nulls last)
    for buckets in (2, 3, 8, 37, 128):
        b = df.withColumn("_b", _bucket(df, [("s", True, True)], buckets))
        spans = b.groupBy("_b").agg(F.min(key).alias("lo"), F.max(key).alias("hi")).orderBy("_b").collect()
        assert all(spans[i].hi <= spans[i + 1].lo for i in range(len(spans) - 1))
        assert {r.id: r["rank"] for r in rank_by(df, "s", partitions=buckets).collect()} == want

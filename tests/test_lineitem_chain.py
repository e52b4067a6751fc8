"""The fitted chain over line items: the window is taken before the join, and a step's rows are dealt out over tasks."""

import datetime as dt
import os
import random

from domainpulse.config import FEATURES, LINEITEM, ClusterParams
from domainpulse.operators import cluster as co
from domainpulse.operators.features import SCALED
from domainpulse.plans import bridges, catalog, chain
from domainpulse.session import cut_lineage


def tables(spark, folder, seed=5):
    """Suppliers, orders and line items of three years; the newest line items have no order, some have no date."""
    rnd = random.Random(seed)
    first = dt.datetime(2020, 1, 1)
    orders = [(k, first + dt.timedelta(days=rnd.randrange(1000))) for k in range(300)]
    lines = [(k, s, rnd.choice("RAN"), rnd.choice("OF"), rnd.choice([0.0, 0.02]), day + dt.timedelta(days=1 + rnd.randrange(60)))
             for k, day in orders for s in rnd.sample(range(12), 4)]
    lines += [(9999, 1, "R", "O", 0.0, dt.datetime(2030, 1, 1)), (5, 2, "R", "O", 0.0, None), (None, 3, "R", "O", 0.0, first)]
    made = {
        "orders": spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp"),
        "lineitem": spark.createDataFrame(
            lines, "l_orderkey long, l_suppkey long, l_returnflag string, l_linestatus string, l_tax double, l_shipdate timestamp"),
        "supplier": spark.createDataFrame([(s, f"S{s}", 0, 1.0) for s in range(12)],
                                          "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "nation": spark.createDataFrame([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string")}
    for name, df in made.items():
        df.write.parquet(os.path.join(folder, f"{name}.parquet"))
    return folder


def filtered_below_join(node, below=False):
    """Whether a filter on the ship date stands under a join."""
    if below and node.nodeName() == "Filter" and "l_shipdate" in node.toString().splitlines()[0] and ">=" in node.toString().splitlines()[0]:
        return True
    below = below or node.nodeName() == "Join"
    return any(filtered_below_join(node.children().apply(i), below) for i in range(node.children().size()))


def test_the_window_is_taken_before_the_join(spark, scratch, monkeypatch):
    base = tables(spark, f"{scratch}/base")
    rollups = []
    summary = chain.kpi_ops.kpi_summary
    monkeypatch.setattr(chain.kpi_ops, "kpi_summary", lambda *a, **b: rollups.append(summary(*a, **b)) or rollups[-1])
    got = catalog.QUERIES["risk_scores_fitted_lineitem"](spark, base)
    assert len(rollups) == 1 and filtered_below_join(rollups[0]._jdf.queryExecution().optimizedPlan())
    # the same rollup as over the metrics of all days, whose last day is the last with an order
    everything = summary(cut_lineage(bridges.lineitem_metrics(spark, base)), LINEITEM.window_days)
    assert sorted(map(repr, rollups[0].collect())) == sorted(map(repr, everything.collect()))
    rows = got.collect()
    assert sorted(r.domain_id for r in rows) == sorted(r.domain_id for r in everything.collect()) and len(rows) == 12


def test_rows_of_a_step_are_dealt_out_over_tasks(spark, monkeypatch):
    """Few bytes of points make many rows with all seeds: the points go to as many tasks as the rows need, with the same fit."""
    rnd = random.Random(4)
    blobs = [(k, [4.0 * k + rnd.random() / 8 for _ in FEATURES]) for k in range(4) for _ in range(100)]
    scaled = spark.createDataFrame([(f"D{i}", *p) for i, (_, p) in enumerate(blobs)],
                                   "domain_id string, " + ", ".join(f"{c} double" for c in SCALED))
    parts, fits = [], []
    fit_points = co.fit_points
    monkeypatch.setattr(co, "fit_points", lambda points, *a: parts.append(points.rdd.getNumPartitions()) or fit_points(points, *a))
    for rows in (co.STEP_ROWS, 500):
        monkeypatch.setattr(co, "STEP_ROWS", rows)
        centers, cost, _ = co.fit_kmeans(scaled, ClusterParams(restarts=10))
        fits.append((sorted([round(x, 9) for x in c] for c in centers), round(cost, 6)))
    assert parts[1] == 8 and parts[0] < 8  # 400 points x 10 seeds
    assert fits[0] == fits[1]

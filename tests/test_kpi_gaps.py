"""Window, rollup and gap rules on hand-made rows (FIXTURES.md section 4)."""

from pyspark.sql import functions as F

from domainpulse.config import GapParams
from domainpulse.operators.gaps import gap_candidates, rank_gaps
from domainpulse.operators.kpi import kpi_summary, window_filter
from helpers import domains, metrics


def test_window_edges(spark):
    m = metrics(spark, [
        ("A", 10, 0.1, 0.1, 1.0, 0),
        ("B", 4, 0.1, 0.1, 1.0, 0),   # 6 days before the max: inside
        ("C", 3, 0.1, 0.1, 1.0, 0),   # 7 days before: outside
    ])
    ids = {r.domain_id for r in kpi_summary(m).collect()}
    assert ids == {"A", "B"}
    assert window_filter(m, 7).count() == 2


def test_rollup_values_and_null_group(spark):
    m = metrics(spark, [
        ("A", 0, 0.10, 0.2, 1.0, 1), ("A", 1, 0.20, 0.4, 3.0, 2),
        (None, 1, 0.5, 0.5, 5.0, 1),
    ])
    rows = {r.domain_id: r for r in kpi_summary(m).collect()}
    assert set(rows) == {"A", None}
    a = rows["A"]
    assert a.snapshot_count == 2 and a.total_missing_fields == 3
    assert a.avg_null_rate == 0.15 and a.avg_stale_rate == 0.3 and a.avg_update_lag_hrs == 2.0
    assert a.max_null_rate == 0.2 and a.max_update_lag_hrs == 3.0


def test_round_half_away_from_zero(spark):
    # 0.00005 average must round up to 0.0001 regardless of summation order
    m = metrics(spark, [("A", 0, 0.0001, 0.0, 0.005, 0), ("A", 1, 0.0, 0.0, 0.0, 0)])
    r = kpi_summary(m).first()
    assert r.avg_null_rate == 0.0001
    assert r.avg_update_lag_hrs == 0.0  # 0.0025 -> 0.00


def _gap(spark, rows, params=GapParams()):
    m = metrics(spark, rows)
    d = domains(spark, [(r[0], f"name {r[0]}", "team", "src") for r in rows if r[0]])
    return {r.domain_id: r for r in gap_candidates(kpi_summary(m), d, params, only_breaches=False).collect()}


def test_strict_thresholds_and_severity(spark):
    g = _gap(spark, [
        ("EQ", 0, 0.15, 0.20, 24.0, 0),
        ("ONE", 0, 0.16, 0.10, 1.0, 0),
        ("TWO", 0, 0.16, 0.21, 1.0, 0),
        ("THREE", 0, 0.16, 0.21, 24.01, 0),
    ])
    assert g["EQ"].breach_count == 0
    assert (g["ONE"].breach_count, g["ONE"].gap_severity) == (1, "MEDIUM")
    assert (g["TWO"].breach_count, g["TWO"].gap_severity) == (2, "HIGH")
    assert (g["THREE"].breach_count, g["THREE"].gap_severity) == (3, "CRITICAL")


def test_breach_filter_and_null_kpi(spark):
    m = metrics(spark, [("N", 0, None, 0.1, 30.0, 0), ("OK", 0, 0.1, 0.1, 1.0, 0)])
    d = domains(spark, [("N", "n", "t", "s"), ("OK", "ok", "t", "s")])
    rows = gap_candidates(kpi_summary(m), d).collect()
    assert [r.domain_id for r in rows] == ["N"]
    assert rows[0].flag_high_nulls == 0 and rows[0].gap_severity == "MEDIUM"


def test_join_drops_orphans_and_null_ids(spark):
    m = metrics(spark, [("X", 0, 0.9, 0.9, 90.0, 0), (None, 0, 0.9, 0.9, 90.0, 0), ("K", 0, 0.9, 0.9, 90.0, 0)])
    d = domains(spark, [("K", "k", "t", "s")])
    assert [r.domain_id for r in gap_candidates(kpi_summary(m), d).collect()] == ["K"]


def test_gap_order(spark):
    m = metrics(spark, [("A", 0, 0.9, 0.9, 30.0, 0), ("B", 0, 0.9, 0.9, 50.0, 0), ("C", 0, 0.9, 0.1, 90.0, 0)])
    d = domains(spark, [("A", "a"), ("B", "b"), ("C", "c")])
    got = [r.domain_id for r in rank_gaps(gap_candidates(kpi_summary(m), d)).collect()]
    assert got == ["B", "A", "C"]


def test_window_predicate_pushed_below_profile(spark):
    import contextlib
    import io

    from domainpulse.plans import bridges
    m = bridges.events_metrics(spark, "/root/testdata/sf0.001")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        kpi_summary(m).explain("formatted")
    plan = buf.getvalue()
    # the anchor filter is evaluated on raw rows, below the profile aggregate,
    # and the scan reads only the three columns the profile needs
    main = plan.split("===== Subqueries =====")[0]
    assert main.index("Filter") > main.index("HashAggregate")  # listed after = deeper in the tree
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in main
    assert F is not None


def test_stored_metrics_window_is_partition_pruned(spark, scratch):
    import contextlib
    import io

    from domainpulse import schemas
    from domainpulse.plans import bridges
    from domainpulse.sources import sinks

    path = f"{scratch}/metrics"
    sinks.append_metrics(spark, bridges.events_metrics(spark, "/root/testdata/sf0.001"), path)
    kpi = kpi_summary(sinks.read_store(spark, path, schemas.METRICS))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        kpi.explain("formatted")
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "Subquery" in plan
    assert "ReadSchema: struct<>" in plan  # the anchor reads partition values only
    assert kpi.count() > 0

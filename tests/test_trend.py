"""Rolling KPIs, score trend and alerts on hand-made rows."""

from domainpulse.config import ScoreParams
from domainpulse.operators.trend import kpi_rolling, latest_alerts, risk_alerts, score_trend
from helpers import metrics


def test_rolling_window_and_copies(spark):
    rows = [("A", d, 0.1 * (d + 1), 0.0, 1.0, 1) for d in range(10)]
    rows += [("A", 9, 0.5, 0.0, 1.0, 1)] * 50          # many copies of one key
    out = {str(r.snapshot_date): r for r in kpi_rolling(metrics(spark, rows), 7).collect()}
    assert len(out) == 10                               # one row per (domain, day)
    last = out["2024-01-10"]
    vals = [0.1 * (d + 1) for d in range(3, 10)] + [0.5] * 50
    assert last.snapshot_count == 57 and last.total_missing_fields == 57
    assert last.avg_null_rate == round(sum(vals) / len(vals), 4)
    assert out["2024-01-01"].snapshot_count == 1


def test_trend_and_alerts(spark):
    params = ScoreParams(ceilings={"avg_null_rate": 1.0, "avg_stale_rate": 1.0,
                                   "avg_update_lag": 24.0, "total_missing_fields": 10.0})
    rows = [("A", 0, 0.0, 0.0, 0.0, 0), ("A", 1, 1.0, 1.0, 48.0, 30), ("B", 0, 0.9, 0.9, 40.0, 20)]
    trend = {(r.domain_id, str(r.snapshot_date)): r for r in score_trend(kpi_rolling(metrics(spark, rows)), params).collect()}
    a0, a1 = trend[("A", "2024-01-01")], trend[("A", "2024-01-02")]
    assert a0.prev_score is None and a1.prev_score == a0.composite_score
    assert a1.score_change == round(a1.composite_score - a0.composite_score, 1)
    alerts = {(r.domain_id, str(r.snapshot_date)): r.alert_reason for r in risk_alerts(
        score_trend(kpi_rolling(metrics(spark, rows)), params)).collect()}
    assert alerts[("A", "2024-01-02")] == "high_tier,tier_rose"
    assert alerts[("B", "2024-01-01")] == "high_tier"
    latest = latest_alerts(score_trend(kpi_rolling(metrics(spark, rows)), params)).collect()
    assert sorted(r.domain_id for r in latest) == ["A", "B"]

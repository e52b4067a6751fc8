"""Oracle SQL for KPI/score trends and alerts."""

from __future__ import annotations

from domainpulse.config import EVENTS, FEATURES
from domainpulse.plans.oracle import EVENTS_METRICS, _band_sql, _rank_sql, query, r, re_, register, score_ctes

W = EVENTS.window_days
ROLLING = ("rolling", f"""
SELECT domain_id, snapshot_date,
       CAST(SUM(n) OVER w AS BIGINT) AS snapshot_count,
       {r('SUM(s_null) OVER w / SUM(c_null) OVER w', 4)} AS avg_null_rate,
       {r('SUM(s_stale) OVER w / SUM(c_stale) OVER w', 4)} AS avg_stale_rate,
       {r('SUM(s_lag) OVER w / SUM(c_lag) OVER w', 2)} AS avg_update_lag_hrs,
       CAST(SUM(s_missing) OVER w AS BIGINT) AS total_missing_fields
FROM (SELECT domain_id, snapshot_date, COUNT(*) AS n,
             SUM(null_rate) AS s_null, COUNT(null_rate) AS c_null,
             SUM(stale_rate) AS s_stale, COUNT(stale_rate) AS c_stale,
             SUM(update_lag_hrs) AS s_lag, COUNT(update_lag_hrs) AS c_lag,
             SUM(missing_fields) AS s_missing
      FROM metrics GROUP BY domain_id, snapshot_date)
WINDOW w AS (PARTITION BY domain_id ORDER BY date_diff('day', DATE '1970-01-01', snapshot_date)
             RANGE BETWEEN {W - 1} PRECEDING AND CURRENT ROW)""")


def _trend_ctes():
    s = EVENTS.score
    comps = []
    src = {"avg_null_rate": "avg_null_rate", "avg_stale_rate": "avg_stale_rate",
           "avg_update_lag": "avg_update_lag_hrs", "total_missing_fields": "total_missing_fields"}
    for c in FEATURES:
        x = f"(CAST({src[c]} AS DOUBLE) / {float(s.ceilings[c])})"
        comps.append(f"CASE WHEN {x} > 1.0 THEN 1.0::DOUBLE ELSE {x} END AS score_{c}")
    weighted = " + ".join(f"score_{c} * {s.weights[c]}" for c in FEATURES)
    contrib = {c: f"(score_{c} * {s.weights[c]})" for c in FEATURES}
    best = "GREATEST(" + ", ".join(contrib.values()) + ")"
    driver = "CASE " + " ".join(f"WHEN {v} = {best} THEN '{k}'" for k, v in contrib.items()) + \
        f" ELSE '{FEATURES[0]}' END"
    scored = f"""
SELECT domain_id, snapshot_date, {re_(f'(({weighted}) * 100)', 1)} AS composite_score, {driver} AS top_driver
FROM (SELECT domain_id, snapshot_date, {', '.join(comps)} FROM rolling)"""
    tiered = f"SELECT *, {_band_sql('composite_score', s.band_mode)} AS risk_tier FROM scored"
    trend = f"""
SELECT *, {r('composite_score - prev_score', 1)} AS score_change FROM (
  SELECT *, LAG(composite_score) OVER p AS prev_score, LAG(risk_tier) OVER p AS prev_tier
  FROM tiered WINDOW p AS (PARTITION BY domain_id ORDER BY snapshot_date))"""
    return [("metrics", EVENTS_METRICS), ROLLING, ("scored", scored), ("tiered", tiered), ("trend", trend)]


ALERTS = f"""
SELECT domain_id, snapshot_date, composite_score, risk_tier, prev_tier, top_driver,
       CONCAT_WS(',', CASE WHEN risk_tier IN ('HIGH', 'CRITICAL') THEN 'high_tier' END,
                      CASE WHEN prev_tier IS NOT NULL AND {_rank_sql('risk_tier')} > {_rank_sql('prev_tier')}
                           THEN 'tier_rose' END) AS alert_reason
FROM {{src}}
WHERE risk_tier IN ('HIGH', 'CRITICAL')
   OR (prev_tier IS NOT NULL AND {_rank_sql('risk_tier')} > {_rank_sql('prev_tier')})"""

register("kpi_rolling", query(_trend_ctes()[:2], "SELECT * FROM rolling"))
register("score_trend", query(_trend_ctes(), "SELECT * FROM trend"))
register("risk_alerts", query(_trend_ctes(), ALERTS.format(src="trend")))
register("risk_alerts_latest", query(_trend_ctes() + [("latest", """
SELECT t.* FROM trend t
WHERE t.snapshot_date = (SELECT MAX(snapshot_date) FROM trend x WHERE x.domain_id = t.domain_id)""")],
    ALERTS.format(src="latest")))


def _run(age: int) -> str:
    """The whole chain as of ``age`` days before the last day."""
    day = f"(SELECT MAX(snapshot_date) - INTERVAL {age} DAY FROM all_metrics)"
    ctes = [("all_metrics", EVENTS_METRICS), ("metrics", f"SELECT * FROM all_metrics WHERE snapshot_date <= {day}")]
    ctes += [c for c in score_ctes("events") if c[0] not in ("metrics", "risk_scores")]
    return "SELECT * FROM (" + query(ctes, f"""SELECT domain_id, CAST({day} AS DATE) AS run_date, composite_score,
       final_tier AS risk_tier, top_driver FROM tiered""") + ")"


register("run_alerts", query([
    ("scores", " UNION ALL ".join(_run(age) for age in (14, 7, 0))),
    ("runs", "SELECT run_date, LAG(run_date) OVER (ORDER BY run_date) AS prev_run FROM (SELECT DISTINCT run_date FROM scores)"),
    ("compared", f"""
SELECT s.*, u.prev_run, p.composite_score AS prev_score, p.risk_tier AS prev_tier, p.top_driver AS prev_driver,
       {r('s.composite_score - p.composite_score', 1)} AS score_change
FROM scores s JOIN runs u USING (run_date)
LEFT JOIN scores p ON p.run_date = u.prev_run AND p.domain_id IS NOT DISTINCT FROM s.domain_id""")],
    f"""
SELECT domain_id, run_date, prev_run, composite_score, prev_score, score_change, risk_tier, prev_tier, top_driver, prev_driver,
       CONCAT_WS(',', CASE WHEN risk_tier IN ('HIGH', 'CRITICAL') THEN 'high_tier' END,
                      CASE WHEN prev_tier IS NOT NULL AND {_rank_sql('risk_tier')} > {_rank_sql('prev_tier')} THEN 'tier_rose' END) AS alert_reason
FROM compared
WHERE risk_tier IN ('HIGH', 'CRITICAL')
   OR (prev_tier IS NOT NULL AND {_rank_sql('risk_tier')} > {_rank_sql('prev_tier')})"""))

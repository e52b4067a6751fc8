"""Oracle SQL for the reporting datasets."""

from __future__ import annotations

from domainpulse.config import FEATURES, TIER_LABELS
from domainpulse.plans.oracle import bridge_ctes, query, r, register, score_ctes
from domainpulse.plans.oracle_quality import REPORT_CTES

BASE = score_ctes("events")
ENR = ("enriched", """SELECT s.*, d.domain_name, d.owner_team, d.data_source
FROM risk_scores s JOIN domains d ON s.domain_id = d.domain_id""")

register("report_overview", query(BASE, f"""
SELECT COUNT(*) AS domains, {r('AVG(composite_score)', 6)} AS avg_score,
       COUNT(*) FILTER (WHERE risk_tier IN ('HIGH', 'CRITICAL')) AS high_risk_domains
FROM risk_scores"""))
register("report_team_tiers", query(BASE + [ENR], "SELECT owner_team, " + ", ".join(
    f"COUNT(*) FILTER (WHERE risk_tier = '{t}') AS {t}" for t in TIER_LABELS)
    + " FROM enriched GROUP BY owner_team"))
register("report_team_avg", query(BASE + [ENR], f"""
SELECT owner_team, {r('AVG(composite_score)', 6)} AS avg_score, COUNT(*) AS domains
FROM enriched GROUP BY owner_team"""))
register("report_top_domains", query(BASE + [ENR], """
SELECT domain_id, domain_name, owner_team, composite_score, risk_tier, top_driver
FROM enriched ORDER BY composite_score DESC, domain_id LIMIT 10"""))
register("report_driver_dist", query(BASE, f"""
SELECT top_driver, COUNT(*) AS domains,
       {r('COUNT(*) / (SELECT COUNT(*) FROM risk_scores)', 6)} AS share
FROM risk_scores GROUP BY top_driver"""))
register("report_team_filter", query(BASE + [ENR], """
SELECT * FROM enriched WHERE owner_team IN ('BUILDING', 'MACHINERY')"""))
register("report_domain_rank", query(BASE, f"""
SELECT domain_id, composite_score, risk_tier,
       RANK() OVER (ORDER BY composite_score DESC) AS score_rank,
       {r('composite_score - (SELECT AVG(composite_score) FROM risk_scores)', 6)} AS score_vs_mean
FROM risk_scores"""))
_LONG = " UNION ALL ".join(f"SELECT domain_id, '{c}' AS kpi, {c} AS value FROM features" for c in FEATURES)
register("report_kpi_long", query(BASE + [("long", _LONG)], f"""
SELECT l.domain_id, l.kpi, l.value,
       {r('CASE WHEN m.mx <> 0 THEN l.value / m.mx END', 6)} AS share_of_max
FROM long l JOIN (SELECT kpi, MAX(value) AS mx FROM long GROUP BY kpi) m ON l.kpi = m.kpi"""))
register("report_cluster_scores", query(BASE, f"""
SELECT cluster_label, COUNT(*) AS domains,
       {r('AVG(composite_score)', 6)} AS avg_score,
       MIN(composite_score) AS min_score,
       {r('QUANTILE_CONT(composite_score, 0.25)', 6)} AS p25_score,
       {r('MEDIAN(composite_score)', 6)} AS median_score,
       {r('QUANTILE_CONT(composite_score, 0.75)', 6)} AS p75_score,
       MAX(composite_score) AS max_score
FROM risk_scores GROUP BY cluster_label"""))
register("report_feature_points", query(BASE, "SELECT s.domain_id, " + ", ".join(
    f"{r(f's.{c}_scaled', 6)} AS {c}_scaled" for c in FEATURES)
    + ", c.cluster_label, c.risk_tier FROM scaled s JOIN clustered c ON s.domain_id = c.domain_id"))
register("recent_audit", query(bridge_ctes("lineitem") + REPORT_CTES, """
SELECT * FROM (SELECT CAST(ROW_NUMBER() OVER (ORDER BY check_order, stage, notes) AS BIGINT) AS run_id,
       stage, status, rows_affected, notes FROM report)
ORDER BY run_id DESC LIMIT 20"""))
register("report_feature_corr", query(BASE, " UNION ALL ".join(
    f"SELECT '{c}' AS kpi, {r(f'CORR(f.{c}, s.composite_score)', 6)} AS corr_with_score "
    f"FROM features f JOIN risk_scores s ON f.domain_id = s.domain_id" for c in FEATURES)))
_TIER_CASE = " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(TIER_LABELS))
register("report_tier_analysis", query(BASE, f"""
SELECT t.risk_tier, CASE t.risk_tier {_TIER_CASE} ELSE 0 END AS tier_rank,
       CAST(COALESCE(x.domains, 0) AS BIGINT) AS domains,
       {r('x.avg_score', 6)} AS avg_score, """ + ", ".join(f"{r(f'x.avg_{c}', 6)} AS avg_{c}" for c in FEATURES) + f"""
FROM (VALUES {", ".join(f"('{t}')" for t in TIER_LABELS)}) AS t(risk_tier)
LEFT JOIN (SELECT s.risk_tier, COUNT(*) AS domains, AVG(s.composite_score) AS avg_score, """
    + ", ".join(f"AVG(f.{c}) AS avg_{c}" for c in FEATURES) + """
  FROM features f JOIN risk_scores s ON f.domain_id = s.domain_id GROUP BY s.risk_tier) x
ON t.risk_tier = x.risk_tier"""))

# The raw features are decimals; the variance weighs their exact differences.
_PTS = ("pts", "SELECT f.domain_id, c.cluster_label, " + ", ".join(f"CAST(f.{c} AS DECIMAL(28,12)) AS {c}" for c in FEATURES)
        + " FROM features f JOIN clustered c ON f.domain_id = c.domain_id")
_WEIGHTS = ("weights", "SELECT " + ", ".join(
    f"CASE WHEN STDDEV_POP({c}) = 0 THEN 0.0::DOUBLE ELSE 1.0 / (STDDEV_POP({c}) * STDDEV_POP({c})) END AS w_{c}"
    for c in FEATURES) + " FROM features")
_SQ = " + ".join(f"CAST(p.{c} - q.{c} AS DOUBLE) * CAST(p.{c} - q.{c} AS DOUBLE) * w_{c}" for c in FEATURES)
register("report_similar_domains", query(BASE + [_PTS, _WEIGHTS], f"""
SELECT domain_id, cluster_label, neighbor_id, CAST(rn AS INTEGER) AS neighbor_rank, {r('SQRT(sq)', 6)} AS distance
FROM (SELECT p.domain_id, p.cluster_label, q.domain_id AS neighbor_id, {_SQ} AS sq,
             ROW_NUMBER() OVER (PARTITION BY p.domain_id ORDER BY {_SQ}, q.domain_id) AS rn
      FROM pts p JOIN pts q ON p.cluster_label = q.cluster_label AND p.domain_id <> q.domain_id, weights)
WHERE rn <= 5"""))

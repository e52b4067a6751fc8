"""DuckDB oracle SQL for every query of the catalog.

Built from shared CTE fragments so each oracle reads the raw tables the
same way the Spark query does.  Rounding follows the decimal recipe of
``functions.rounding`` (``ROUND`` / ``ROUND_EVEN`` on DECIMAL(28,12)).
"""

from __future__ import annotations

from domainpulse.config import (
    DEMO_CENTROIDS, EVENTS, FEATURES, LINEITEM, REFERENCE, REFERENCE_BANDS, TIER_LABELS, PipelineConfig,
)


def r(expr: str, n: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,12)), {n}) AS DOUBLE)"


def re_(expr: str, n: int) -> str:
    return f"CAST(ROUND_EVEN(CAST({expr} AS DECIMAL(28,12)), {n}) AS DOUBLE)"


def with_(*ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS (\n{body}\n)" for name, body in ctes)


# --- bridges -------------------------------------------------------------
EVENTS_METRICS = """
SELECT 'U' || CAST(user_id AS VARCHAR) AS domain_id,
       CAST(ts AS DATE) AS snapshot_date,
       COUNT(*) AS total_records,
       AVG(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS null_rate,
       AVG(CASE WHEN hour(ts) < 12 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS stale_rate,
       CAST(24 - MAX(hour(ts)) AS DOUBLE) AS update_lag_hrs,
       CAST(5 - COUNT(DISTINCT event_type) AS BIGINT) AS missing_fields
FROM events
GROUP BY 1, 2"""

EVENTS_DOMAINS = """
SELECT 'U' || CAST(c.c_custkey AS VARCHAR) AS domain_id,
       c.c_name AS domain_name, c.c_mktsegment AS owner_team, n.n_name AS data_source
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""

LINEITEM_METRICS = """
SELECT 'S' || CAST(l.l_suppkey AS VARCHAR) AS domain_id,
       CAST(l.l_shipdate AS DATE) AS snapshot_date,
       COUNT(*) AS total_records,
       AVG(CASE WHEN l.l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS null_rate,
       AVG(CASE WHEN l.l_linestatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS stale_rate,
       CAST(MAX(CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE)) AS DOUBLE) AS update_lag_hrs,
       CAST(COUNT(*) FILTER (WHERE l.l_tax = 0) AS BIGINT) AS missing_fields
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY 1, 2"""

LINEITEM_DOMAINS = """
SELECT 'S' || CAST(s.s_suppkey AS VARCHAR) AS domain_id,
       s.s_name AS domain_name, r.r_name AS owner_team, n.n_name AS data_source
FROM supplier s
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE s.s_acctbal > 0"""

EVENTS_KEYS = """
SELECT 'U' || CAST(user_id AS VARCHAR) AS domain_id, CAST(ts AS DATE) AS snapshot_date
FROM events"""


def kpi_body(metrics: str, window_days: int) -> str:
    return f"""
SELECT domain_id,
       MAX(snapshot_date) AS latest_snapshot,
       COUNT(*) AS snapshot_count,
       {r('AVG(null_rate)', 4)} AS avg_null_rate,
       {r('AVG(stale_rate)', 4)} AS avg_stale_rate,
       {r('AVG(update_lag_hrs)', 2)} AS avg_update_lag_hrs,
       CAST(SUM(missing_fields) AS BIGINT) AS total_missing_fields,
       {r('MAX(null_rate)', 4)} AS max_null_rate,
       {r('MAX(stale_rate)', 4)} AS max_stale_rate,
       {r('MAX(update_lag_hrs)', 2)} AS max_update_lag_hrs
FROM {metrics}
WHERE snapshot_date >= (SELECT MAX(snapshot_date) - INTERVAL {window_days - 1} DAY FROM {metrics})
GROUP BY domain_id"""


def bridge_ctes(which: str, cfg: PipelineConfig | None = None) -> list[tuple[str, str]]:
    if which == "events":
        cfg = cfg or EVENTS
        return [("metrics", EVENTS_METRICS), ("domains", EVENTS_DOMAINS),
                ("kpi", kpi_body("metrics", cfg.window_days))]
    cfg = cfg or LINEITEM
    return [("metrics", LINEITEM_METRICS), ("domains", LINEITEM_DOMAINS),
            ("kpi", kpi_body("metrics", cfg.window_days))]


def gaps_body(cfg: PipelineConfig, only_breaches: bool = True) -> str:
    g = cfg.gaps
    lag = f"k.avg_update_lag_hrs > {g.lag_hrs}"
    nul = f"k.avg_null_rate > {g.null_rate}"
    sta = f"k.avg_stale_rate > {g.stale_rate}"
    flags = f"""(CASE WHEN {lag} THEN 1 ELSE 0 END) + (CASE WHEN {nul} THEN 1 ELSE 0 END)
            + (CASE WHEN {sta} THEN 1 ELSE 0 END)"""
    where = f"WHERE {lag} OR {nul} OR {sta}" if only_breaches else ""
    return f"""
SELECT k.domain_id, d.domain_name, d.owner_team, d.data_source,
       k.latest_snapshot, k.snapshot_count, k.avg_null_rate, k.avg_stale_rate,
       k.avg_update_lag_hrs, k.total_missing_fields, k.max_null_rate, k.max_stale_rate,
       k.max_update_lag_hrs,
       CASE WHEN {lag} THEN 1 ELSE 0 END AS flag_stale_lag,
       CASE WHEN {nul} THEN 1 ELSE 0 END AS flag_high_nulls,
       CASE WHEN {sta} THEN 1 ELSE 0 END AS flag_high_stale,
       {flags} AS breach_count,
       CASE WHEN {flags} = 3 THEN 'CRITICAL' WHEN {flags} = 2 THEN 'HIGH' ELSE 'MEDIUM' END AS gap_severity
FROM kpi k JOIN domains d ON k.domain_id = d.domain_id
{where}"""


# --- features ------------------------------------------------------------
FEATURES_RAW = """
SELECT domain_id,
       CAST(avg_null_rate AS DOUBLE) AS avg_null_rate,
       CAST(avg_stale_rate AS DOUBLE) AS avg_stale_rate,
       CAST(avg_update_lag_hrs AS DOUBLE) AS avg_update_lag,
       CAST(total_missing_fields AS DOUBLE) AS total_missing_fields
FROM kpi"""


def imputed_body(src: str = "features_raw") -> str:
    cols = ",\n       ".join(f"COALESCE({c}, (SELECT MEDIAN({c}) FROM {src})) AS {c}" for c in FEATURES)
    return f"SELECT domain_id,\n       {cols}\nFROM {src}"


def scaled_body(src: str = "features") -> str:
    stats = ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in FEATURES)
    cols = ",\n       ".join(
        f"CASE WHEN s.s_{c} = 0 THEN 0.0::DOUBLE ELSE (f.{c} - s.m_{c}) / s.s_{c} END AS {c}_scaled"
        for c in FEATURES)
    return f"SELECT f.domain_id,\n       {cols}\nFROM {src} f CROSS JOIN (SELECT {stats} FROM {src}) s"


def feature_ctes(which: str, cfg: PipelineConfig | None = None) -> list[tuple[str, str]]:
    return bridge_ctes(which, cfg) + [
        ("features_raw", FEATURES_RAW),
        ("features", imputed_body()),
        ("scaled", scaled_body()),
    ]


def centroid_values(centroids=DEMO_CENTROIDS) -> str:
    rows = ", ".join("(" + ", ".join([str(i)] + [f"{v}::DOUBLE" for v in c]) + ")"
                     for i, c in enumerate(centroids))
    names = ", ".join(["cid"] + [f"c{j}" for j in range(len(FEATURES))])
    return f"SELECT * FROM (VALUES {rows}) AS t({names})"


def centroid_tier_body() -> str:
    sev = " + ".join(f"c{j}" for j in range(len(FEATURES)))
    labels = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(TIER_LABELS))
    return f"""
SELECT cid, severity, rnk AS cluster_label, CASE rnk {labels} END AS risk_tier
FROM (SELECT cid, ({sev}) / {len(FEATURES)}.0 AS severity,
             CAST(ROW_NUMBER() OVER (ORDER BY ({sev}) / {len(FEATURES)}.0, cid) - 1 AS INTEGER) AS rnk
      FROM centroids)"""


def assign_body() -> str:
    dist = " + ".join(f"(s.{c}_scaled - c.c{j}) * (s.{c}_scaled - c.c{j})" for j, c in enumerate(FEATURES))
    return f"""
SELECT domain_id, cid, dist FROM (
  SELECT s.domain_id, c.cid, {dist} AS dist,
         ROW_NUMBER() OVER (PARTITION BY s.domain_id ORDER BY {dist}, c.cid) AS rn
  FROM scaled s CROSS JOIN centroids c)
WHERE rn = 1"""


def clustered_body() -> str:
    cols = ", ".join(f"f.{c}" for c in FEATURES)
    return f"""
SELECT f.domain_id, {cols}, t.cluster_label, t.risk_tier
FROM features f JOIN assigned a ON f.domain_id = a.domain_id
JOIN centroid_tiers t ON a.cid = t.cid"""


def cluster_ctes(which: str, cfg: PipelineConfig | None = None) -> list[tuple[str, str]]:
    return feature_ctes(which, cfg) + [
        ("centroids", centroid_values()),
        ("centroid_tiers", centroid_tier_body()),
        ("assigned", assign_body()),
        ("clustered", clustered_body()),
    ]


def _band_sql(score: str, mode: str) -> str:
    if mode == "reference":
        whens = " ".join(f"WHEN {score} >= {lo} AND {score} <= {hi} THEN '{t}'" for lo, hi, t in REFERENCE_BANDS)
        return f"CASE {whens} ELSE 'LOW' END"
    return (f"CASE WHEN {score} > 75 THEN 'CRITICAL' WHEN {score} > 50 THEN 'HIGH' "
            f"WHEN {score} > 25 THEN 'MEDIUM' ELSE 'LOW' END")


def _rank_sql(tier: str) -> str:
    whens = " ".join(f"WHEN {tier} = '{t}' THEN {i}" for i, t in enumerate(TIER_LABELS))
    return f"(CASE {whens} ELSE 0 END)"


def components_body(cfg: PipelineConfig, src: str = "clustered") -> str:
    comps = []
    for c in FEATURES:
        ceil = cfg.score.ceilings[c]
        x = f"({c} / {float(ceil)})"
        comps.append(f"CASE WHEN {x} > 1.0 THEN 1.0::DOUBLE ELSE {x} END AS score_{c}")
    return f"SELECT *, {', '.join(comps)} FROM {src}"


def scored_body(cfg: PipelineConfig, src: str = "components") -> str:
    w = cfg.score.weights
    weighted = " + ".join(f"score_{c} * {w[c]}" for c in FEATURES)
    score = re_(f"(({weighted}) * 100)", 1)
    return f"SELECT *, {score} AS composite_score FROM {src}"


def tiered_body(cfg: PipelineConfig, src: str = "scored") -> str:
    w = cfg.score.weights
    contrib = {c: f"(score_{c} * {w[c]})" for c in FEATURES}
    best = "GREATEST(" + ", ".join(contrib.values()) + ")"
    driver = "CASE " + " ".join(f"WHEN {v} = {best} THEN '{k}'" for k, v in contrib.items()) + \
        f" ELSE '{FEATURES[0]}' END"
    band = _band_sql("composite_score", cfg.score.band_mode)
    return f"""
SELECT *, CASE WHEN {_rank_sql('cluster_tier')} > {_rank_sql('score_tier')} + 1
               THEN cluster_tier ELSE score_tier END AS final_tier
FROM (SELECT *, risk_tier AS cluster_tier, {band} AS score_tier, {driver} AS top_driver FROM {src})"""


def score_ctes(which: str, cfg: PipelineConfig | None = None, run_date: str = "2024-02-01") -> list[tuple[str, str]]:
    cfg = cfg or (EVENTS if which == "events" else LINEITEM)
    return cluster_ctes(which, cfg) + [
        ("components", components_body(cfg)),
        ("scored", scored_body(cfg)),
        ("tiered", tiered_body(cfg)),
        ("risk_scores", f"""
SELECT domain_id, DATE '{run_date}' AS run_date, composite_score, cluster_label,
       final_tier AS risk_tier, top_driver
FROM tiered"""),
    ]


def query(ctes: list[tuple[str, str]], select: str) -> str:
    return with_(*ctes) + "\n" + select


ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


# --- registrations -------------------------------------------------------
register("profile_events", EVENTS_METRICS)
register("profile_lineitem", LINEITEM_METRICS)
register("window_filter", query(bridge_ctes("events"), """
SELECT * FROM metrics
WHERE snapshot_date >= (SELECT MAX(snapshot_date) - INTERVAL 6 DAY FROM metrics)"""))
register("kpi_summary", query(bridge_ctes("events"), "SELECT * FROM kpi"))
register("kpi_lineitem", query(bridge_ctes("lineitem"), "SELECT * FROM kpi"))
register("kpi_ranked", query(bridge_ctes("events"), "SELECT * FROM kpi ORDER BY avg_null_rate DESC, domain_id"))
register("feature_input", query(bridge_ctes("events"), """
SELECT domain_id, avg_null_rate, avg_stale_rate, avg_update_lag_hrs, total_missing_fields
FROM kpi ORDER BY domain_id"""))
register("gap_candidates", query(bridge_ctes("events") + [("gaps", gaps_body(EVENTS))],
                                 "SELECT * FROM gaps ORDER BY breach_count DESC, avg_update_lag_hrs DESC, domain_id"))
register("gap_candidates_reference", query(bridge_ctes("events") + [("gaps", gaps_body(REFERENCE))],
                                           "SELECT * FROM gaps"))
register("gap_all_domains", query(bridge_ctes("events") + [("gaps", gaps_body(EVENTS, False))],
                                  "SELECT * FROM gaps"))
register("gap_lineitem", query(bridge_ctes("lineitem") + [("gaps", gaps_body(LINEITEM))],
                               "SELECT * FROM gaps").replace("WHERE s.s_acctbal > 0", ""))


# --- features, clusters, scores -------------------------------------------
def r6cols(cols) -> str:
    return ", ".join(f"{r(c, 6)} AS {c}" for c in cols)


SCALED_COLS = [f"{c}_scaled" for c in FEATURES]
EV = "events"
register("feature_null_counts", query(bridge_ctes(EV), "SELECT COUNT(*) AS n_rows, " + ", ".join(
    f"COUNT(*) FILTER (WHERE {src} IS NULL) AS nulls_{c}" for c, src in zip(
        FEATURES, ["avg_null_rate", "avg_stale_rate", "avg_update_lag_hrs", "total_missing_fields"])) + " FROM kpi"))
register("features_raw", query(feature_ctes(EV), "SELECT * FROM features_raw"))
register("features_imputed", query(feature_ctes(EV), "SELECT * FROM features"))
_TAKEN = ", ".join(
    f"CASE WHEN CAST(substr(domain_id, 2) AS BIGINT) % 5 <> {j} THEN {c} END AS {c}" for j, c in enumerate(FEATURES))
register("features_imputed_nulls", query(
    [cte for name, sql in feature_ctes(EV) for cte in (
        [("features_all", sql), (name, f"SELECT domain_id, {_TAKEN} FROM features_all")] if name == "features_raw"
        else [(name, sql)])], "SELECT * FROM features"))
register("features_scaled", query(feature_ctes(EV), f"SELECT domain_id, {r6cols(SCALED_COLS)} FROM scaled"))
register("features_scaled_lineitem", query(feature_ctes("lineitem"),
                                           f"SELECT domain_id, {r6cols(SCALED_COLS)} FROM scaled"))
register("scaler_params", query(feature_ctes(EV), "SELECT feature, " + r("mean", 6) + " AS mean, " + r("std", 6)
    + " AS std FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, AVG({c}) AS mean, STDDEV_POP({c}) AS std FROM features" for c in FEATURES) + ")"))
register("nearest_centroid", query(cluster_ctes(EV), f"""
SELECT a.domain_id, t.cluster_label, t.risk_tier, {r('a.dist', 6)} AS centroid_dist
FROM assigned a JOIN centroid_tiers t ON a.cid = t.cid"""))
register("centroid_rank", query(cluster_ctes(EV), f"""
SELECT t.cid, {r('t.severity', 6)} AS severity, t.cluster_label, t.risk_tier,
       CAST(COALESCE(m.members, 0) AS BIGINT) AS members
FROM centroid_tiers t LEFT JOIN (SELECT cid, COUNT(*) AS members FROM assigned GROUP BY cid) m ON t.cid = m.cid"""))
register("kmeans_invariants", query(feature_ctes(EV), f"""
SELECT domain_id, CAST({EVENTS.cluster.k} AS INTEGER) AS clusters, TRUE AS label_known, TRUE AS own_mean_nearest,
       TRUE AS tier_by_rank, TRUE AS ranked_by_severity, TRUE AS cheaper_than_fixed
FROM features"""))
register("tier_profile", query(cluster_ctes(EV), "SELECT risk_tier, COUNT(*) AS domains, " + ", ".join(
    f"{r(f'AVG({c})', 6)} AS mean_{c}" for c in FEATURES) + " FROM clustered GROUP BY risk_tier"))
register("tier_distribution", query(cluster_ctes(EV), """
SELECT t.risk_tier, t.tier_order, CAST(COALESCE(c.domains, 0) AS BIGINT) AS domains
FROM (VALUES ('CRITICAL', 0), ('HIGH', 1), ('MEDIUM', 2), ('LOW', 3)) AS t(risk_tier, tier_order)
LEFT JOIN (SELECT risk_tier, COUNT(*) AS domains FROM clustered GROUP BY risk_tier) c
  ON t.risk_tier = c.risk_tier
ORDER BY t.tier_order"""))
register("score_components", query(score_ctes(EV), "SELECT domain_id, " + r6cols(
    [f"score_{c}" for c in FEATURES]) + ", composite_score FROM tiered"))
register("composite_score", query(score_ctes(EV), "SELECT domain_id, composite_score FROM tiered"))
register("score_tier", query(score_ctes(EV), "SELECT domain_id, composite_score, score_tier FROM tiered"))
_CONTIG = PipelineConfig(window_days=EVENTS.window_days, gaps=EVENTS.gaps,
                         score=EVENTS.score.__class__(EVENTS.score.weights, EVENTS.score.ceilings, "contiguous"))
register("score_tier_contiguous", query(score_ctes(EV, _CONTIG),
                                        "SELECT domain_id, composite_score, score_tier FROM tiered"))
register("reconciled_tier", query(score_ctes(EV), """
SELECT domain_id, score_tier, cluster_tier, final_tier AS risk_tier FROM tiered"""))
register("top_driver", query(score_ctes(EV), "SELECT domain_id, top_driver FROM tiered"))
register("risk_scores", query(score_ctes(EV), "SELECT * FROM risk_scores"))
register("risk_scores_reference", query(score_ctes(EV, PipelineConfig(window_days=7, gaps=EVENTS.gaps)),
                                        "SELECT * FROM risk_scores"))
register("risk_scores_lineitem", query(score_ctes("lineitem"), "SELECT * FROM risk_scores"))
register("risk_ranking", query(score_ctes(EV), "SELECT * FROM risk_scores ORDER BY composite_score DESC, domain_id"))

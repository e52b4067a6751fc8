"""Oracle SQL for the data-quality checks and the audit rows."""

from __future__ import annotations

from domainpulse.config import NULL_CHECK_COLUMNS, RANGE_CHECKS
from domainpulse.plans.oracle import EVENTS_KEYS, bridge_ctes, query, register


def dup_issue_sql(src: str) -> str:
    return f"""SELECT * FROM (
SELECT CAST(400 AS INTEGER) AS check_order, 'validate.coverage_metrics.duplicate_keys' AS stage,
       'WARNING' AS status, CAST(SUM(copies) AS BIGINT) AS rows_affected,
       printf('%d keys (domain_id, snapshot_date) stand in more than one row', COUNT(*)) AS notes
FROM (SELECT domain_id, snapshot_date, COUNT(*) AS copies FROM {src}
      GROUP BY domain_id, snapshot_date HAVING COUNT(*) > 1)) WHERE rows_affected > 0"""


def null_issue_sql(src: str, table: str, cols, base: int) -> str:
    parts = []
    for i, c in enumerate(cols):
        n = f"(SELECT COUNT(*) FILTER (WHERE {c} IS NULL) FROM {src})"
        note = f"printf('%d rows without {c}', {n})"
        parts.append(f"SELECT CAST({base + i} AS INTEGER) AS check_order, 'validate.{table}.nulls.{c}' AS stage, "
                     f"'WARNING' AS status, CAST({n} AS BIGINT) AS rows_affected, {note} AS notes")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE rows_affected > 0"


def range_issue_sql(src: str) -> str:
    parts = []
    for i, (c, lo, hi, desc) in enumerate(RANGE_CHECKS):
        v = f"TRY_CAST({c} AS DOUBLE)"
        for off, bound, op, word in ((0, lo, "<", "less than"), (1, hi, ">", "more than")):
            if bound is None:
                continue
            n = f"(SELECT COUNT(*) FILTER (WHERE {v} {op} {float(bound)}) FROM {src})"
            note = f"printf('%d rows with {c}, {desc}, {word} {bound}', {n})"
            parts.append(
                f"SELECT CAST({600 + 2 * i + off} AS INTEGER) AS check_order, "
                f"'validate.coverage_metrics.range.{c}' AS stage, 'WARNING' AS status, "
                f"CAST({n} AS BIGINT) AS rows_affected, {note} AS notes")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE rows_affected > 0"


def orphan_ids_sql(metrics: str, domains: str) -> str:
    return f"""SELECT m.domain_id, COUNT(*) AS rows FROM {metrics} m
WHERE m.domain_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {domains} d WHERE d.domain_id = m.domain_id)
GROUP BY m.domain_id"""


def orphan_issue_sql(metrics: str, domains: str) -> str:
    return f"""SELECT * FROM (
SELECT CAST(700 AS INTEGER) AS check_order, 'validate.coverage_metrics.referential_integrity' AS stage,
       'WARNING' AS status, CAST(SUM(rows) AS BIGINT) AS rows_affected,
       printf('%d domain ids of the metrics belong to no domain', COUNT(*)) AS notes
FROM ({orphan_ids_sql(metrics, domains)})) WHERE rows_affected > 0"""


def all_issues_sql(metrics: str = "metrics", domains: str = "domains") -> str:
    return " UNION ALL ".join([
        null_issue_sql(domains, "domains", NULL_CHECK_COLUMNS["domains"], 200),
        dup_issue_sql(metrics),
        null_issue_sql(metrics, "coverage_metrics", NULL_CHECK_COLUMNS["coverage_metrics"], 500),
        range_issue_sql(metrics),
        orphan_issue_sql(metrics, domains),
    ])


def report_sql(metrics: str = "metrics") -> str:
    return f"""SELECT * FROM issues UNION ALL
SELECT CAST(0 AS INTEGER), 'validate', 'SUCCESS', CAST(COUNT(*) AS BIGINT), 'no issue in any check'
FROM {metrics} HAVING (SELECT COUNT(*) FROM issues) = 0"""


EV, LI = "events", "lineitem"
ENRICHED = ("enriched", "SELECT m.*, d.domain_name, d.owner_team, d.data_source FROM metrics m "
                        "LEFT JOIN domains d ON m.domain_id = d.domain_id")
REPORT_CTES = [("issues", all_issues_sql()), ("report", report_sql())]

register("dq_duplicate_keys", query([("keys", EVENTS_KEYS)], dup_issue_sql("keys")))
register("dq_duplicate_pairs", query([("keys", EVENTS_KEYS)], """
SELECT domain_id, snapshot_date, COUNT(*) AS copies FROM keys
GROUP BY domain_id, snapshot_date HAVING COUNT(*) > 1"""))
register("dq_nulls", query(bridge_ctes(LI) + [ENRICHED], null_issue_sql(
    "enriched", "coverage_metrics_enriched",
    ("domain_id", "domain_name", "owner_team", "data_source", "null_rate", "update_lag_hrs"), 800)))
register("dq_ranges", query(bridge_ctes(LI), range_issue_sql("metrics")))
register("dq_orphans", query(bridge_ctes(LI), orphan_issue_sql("metrics", "domains")))
register("dq_orphan_ids", query(bridge_ctes(LI), orphan_ids_sql("metrics", "domains")))
register("dq_all_issues", query(bridge_ctes(LI), all_issues_sql()))
register("dq_report", query(bridge_ctes(EV) + [("issues", all_issues_sql())], report_sql()))
register("dq_report_lineitem", query(bridge_ctes(LI) + [("issues", all_issues_sql())], report_sql()))
register("dq_status_counts", query(bridge_ctes(LI) + REPORT_CTES,
                                   "SELECT status, COUNT(*) AS issues FROM report GROUP BY status"))
register("audit_rows", query(bridge_ctes(LI) + REPORT_CTES, """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY check_order, stage, notes) AS BIGINT) AS run_id,
       stage, status, rows_affected, notes FROM report"""))

"""Oracle SQL for the append-safe loads and surrogate keys."""

from __future__ import annotations

from domainpulse.plans.oracle import bridge_ctes, query, register

EV = "events"
HISTORY = ("stored", "SELECT * FROM metrics WHERE snapshot_date < "
                     "(SELECT MAX(snapshot_date) - INTERVAL 6 DAY FROM metrics)")
NEW = ("fresh", """SELECT m.* FROM metrics m WHERE NOT EXISTS (
  SELECT 1 FROM stored s
  WHERE s.domain_id IS NOT DISTINCT FROM m.domain_id AND s.snapshot_date IS NOT DISTINCT FROM m.snapshot_date)""")

register("ingest_new_metrics", query(bridge_ctes(EV) + [HISTORY, NEW], "SELECT * FROM fresh"))
register("ingest_new_domains", query(bridge_ctes(EV), """
SELECT d.* FROM domains d
WHERE d.domain_name IS NOT NULL
  AND d.domain_id NOT IN (SELECT domain_id FROM metrics WHERE domain_id IS NOT NULL)"""))
register("ingest_counts", query(bridge_ctes(EV) + [HISTORY, NEW], """
SELECT (SELECT COUNT(*) FROM stored) AS rows_before,
       (SELECT COUNT(*) FROM metrics) AS rows_incoming,
       (SELECT COUNT(*) FROM fresh) AS rows_inserted,
       (SELECT COUNT(*) FROM stored) + (SELECT COUNT(*) FROM fresh) AS rows_after"""))
register("surrogate_key", query(bridge_ctes(EV), """
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY snapshot_date, domain_id) AS BIGINT) AS metric_id FROM metrics"""))

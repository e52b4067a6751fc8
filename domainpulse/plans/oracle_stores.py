"""Oracle SQL for deliveries, stores and exports: what went out is what comes back."""

from __future__ import annotations

from domainpulse.config import EVENTS
from domainpulse.plans.oracle import bridge_ctes, gaps_body, query, register, score_ctes

METRICS = query(bridge_ctes("events"), "SELECT * FROM metrics")

register("csv_metrics", METRICS)
register("stored_metrics", METRICS)
register("streamed_metrics", METRICS)
register("csv_domains", query(bridge_ctes("events"), "SELECT * FROM domains"))
register("stored_chain_scores", query(score_ctes("events"), "SELECT * FROM risk_scores"))
register("exported_scores", query(score_ctes("events"), "SELECT * FROM risk_scores"))
register("published_gaps", query(bridge_ctes("events") + [("gaps", gaps_body(EVENTS))],
                                 "SELECT * FROM gaps ORDER BY breach_count DESC, avg_update_lag_hrs DESC, domain_id"))

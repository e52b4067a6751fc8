"""Benchmark the registered headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, median reported; default 3).
Each query is built and forced with a no-op sink (full execution, no
collect); what it checkpoints is removed after each run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from domainpulse.plans.registry import QUERIES  # noqa: E402
from domainpulse.session import intermediates, local_session  # noqa: E402

#: Name in the report: the registered query that it times.
TIMED = {
    "events_kpi": "kpi_summary",
    "lineitem_kpi": "kpi_lineitem",
    "lineitem_gaps": "gap_lineitem",
    "dq_report": "dq_report_lineitem",
    "events_trend_alerts": "risk_alerts",
    "events_chain_scores": "risk_scores_fitted",
    "lineitem_chain_scores": "risk_scores_fitted_lineitem",
}


def timed(spark, name: str, base: str) -> float:
    with intermediates(spark):
        start = time.perf_counter()
        QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start


def main():
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="domainpulse-bench")
    spark.sparkContext.setLogLevel("ERROR")
    for query in TIMED.values():  # warm-up: JIT, file listing
        timed(spark, query, base)
    samples = {name: [timed(spark, query, base) for _ in range(runs)] for name, query in TIMED.items()}
    times = {name: round(statistics.median(s), 3) for name, s in samples.items()}
    sf = Path(base).name.replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "range": {name: [round(min(s), 3), round(max(s), 3)] for name, s in samples.items()},
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))


if __name__ == "__main__":
    main()

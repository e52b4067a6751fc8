"""Small builders for hand-made metric and domain rows."""

from __future__ import annotations

import datetime as dt

from domainpulse import schemas


def day(n: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def metrics(spark, rows):
    """rows: (domain_id, day offset or date or None, null, stale, lag, missing[, total])."""
    out = []
    for r in rows:
        d = r[1] if (r[1] is None or isinstance(r[1], dt.date)) else day(r[1])
        total = r[6] if len(r) > 6 else 100
        out.append((r[0], d, total, r[2], r[3], r[4], r[5], None))
    return spark.createDataFrame(out, schemas.METRICS)


def domains(spark, rows):
    return spark.createDataFrame([tuple(r) + (None,) * (4 - len(r)) for r in rows], schemas.DOMAINS)

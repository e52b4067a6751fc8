"""Import every catalog and oracle module; expose the two registries."""

from domainpulse.plans import (  # noqa: F401
    catalog, catalog_ingest, catalog_quality, catalog_reports, catalog_stores, catalog_trend,
)
from domainpulse.plans import (  # noqa: F401
    oracle, oracle_ingest, oracle_quality, oracle_reports, oracle_stores, oracle_trend,
)

QUERIES = catalog.QUERIES
ORACLE = oracle.ORACLE

"""All registered queries: name -> (Spark query, the same as SQL or None)."""

from sievemill.plans import catalog_loads, catalog_quality, catalog_sources

QUERIES = {**catalog_quality.QUERIES, **catalog_sources.QUERIES, **catalog_loads.QUERIES}

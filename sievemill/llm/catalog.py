"""Registered queries of this subpackage: name -> (Spark query, the same as SQL or None)."""

from sievemill.llm import corpus_queries, dedup_queries, mining_queries

QUERIES = {**corpus_queries.QUERIES, **dedup_queries.QUERIES, **mining_queries.QUERIES}

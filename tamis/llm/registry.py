"""The queries of this subpackage and their SQL, as the entry module registers them."""

from tamis.llm import oracles, queries

QUERIES = queries.QUERIES
ORACLES = oracles.ORACLES

"""The operators bound to the supplied tables, each with the SQL that states the same result."""

from millrace.plans import documents, hashes, index, order_joins, tables, training, vectors, weather

_MODULES = (weather, order_joins, hashes, documents, index, vectors, tables, training)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}

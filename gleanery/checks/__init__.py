"""Queries on the supplied tables, each with the SQL that must give the same rows."""

from . import documents, flows, history, increments, loads, matching, storage, text

MODULES = (text, history, matching, documents, flows, storage, loads, increments)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}

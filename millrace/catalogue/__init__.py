"""Registered queries with their DuckDB counterparts."""

from millrace.catalogue import cells, files, groups, increments, keys, rows, scalars

_MODULES = (rows, groups, scalars, keys, cells, files, increments)

QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
SQL = {name: s for m in _MODULES for name, s in m.SQL.items()}

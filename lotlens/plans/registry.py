"""All queries by name, with DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from lotlens.plans import artifacts, details, dossiers, monitoring, parcels, records, scoring, tables, taxes, valuation

_MODULES = (valuation, scoring, monitoring, records, details, parcels, artifacts, tables, dossiers, taxes)

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
SQL = {name: text for m in _MODULES for name, text in m.SQL.items()}

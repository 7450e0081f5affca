"""All queries of the core, by name, with the SQL of those that SQL can express."""

from __future__ import annotations

from tarnwerk.plans import calibrated, events, more, problems, profiled, records, risks, search, selected, texts

_MODULES = (problems, records, search, events, more, texts, profiled, calibrated, risks, selected)
QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
SQL = {k: s for m in _MODULES for k, s in m.SQL.items()}

"""All queries of the reference's own operators, by name, and their SQL. Names begin with the operators that they show."""

from __future__ import annotations

from . import contacts, funnel, graph, icp, identities, lookups, master, matching, outreach, paging, records, scalars, streams, verticals

PARTS = [icp, contacts, funnel, graph, identities, lookups, master, matching, outreach, paging, records, scalars, streams, verticals]
QUERIES = {name: query for part in PARTS for name, query in part.QUERIES.items()}
ORACLE_SQL = {name: sql for part in PARTS for name, sql in part.SQL.items()}

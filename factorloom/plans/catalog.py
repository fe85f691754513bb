"""All queries of the core, by name, and the SQL that they are compared with."""

from __future__ import annotations

from factorloom.plans import factor_queries, problems, research_queries

QUERIES = {**problems.QUERIES, **factor_queries.QUERIES, **research_queries.QUERIES}
ORACLE_SQL = {**problems.ORACLE_SQL, **factor_queries.ORACLE_SQL, **research_queries.ORACLE_SQL}
FLAGSHIP = "f_chain"

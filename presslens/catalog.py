"""All feed queries by name, with the SQL that each must equal."""

from __future__ import annotations

from presslens.plans import desk, feed, ingest, judge, polish, state, stories, upkeep  # noqa: F401  all register their queries

QUERIES: dict = dict(feed.QUERIES)
ORACLE_SQL: dict = dict(feed.ORACLE_SQL)

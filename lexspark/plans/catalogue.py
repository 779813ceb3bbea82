"""All queries of the legal-document engine, with their SQL."""

from __future__ import annotations

from lexspark.plans import conversions, deliveries, tables, texts

QUERIES = texts.QUERIES | tables.QUERIES | deliveries.QUERIES | conversions.QUERIES
ORACLE_SQL = texts.ORACLE_SQL | tables.ORACLE_SQL | deliveries.ORACLE_SQL | conversions.ORACLE_SQL

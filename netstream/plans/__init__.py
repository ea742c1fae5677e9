"""Registered queries (``queries()``) and their DuckDB oracles (``oracle_sql()``)."""

"""The registered queries and their DuckDB counterparts."""

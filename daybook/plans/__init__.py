"""End-to-end plans: the reference's jobs composed from operators, and the
catalog of registered queries with their DuckDB oracles."""

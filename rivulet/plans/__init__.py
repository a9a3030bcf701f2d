"""The Flow name space, the query catalogue and its DuckDB oracles."""

"""Query registry (Spark callables) and their independent DuckDB SQL oracles."""

"""Independent SQL statements of every registered query, for DuckDB over the given parquet tables."""

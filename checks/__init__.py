"""Oracle SQL (DuckDB) and the local Spark-vs-DuckDB comparison."""

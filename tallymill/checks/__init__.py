"""DuckDB statements that state, independently of Spark, what each query returns."""

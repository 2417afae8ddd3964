"""The model graph (``Models``), the build with its quality gate, and the registered
queries with their DuckDB oracle SQL."""

"""Query catalog over the test tables and the matching DuckDB oracle SQL."""

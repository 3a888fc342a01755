"""Query keys over the driver's tables, and their DuckDB oracle SQL."""

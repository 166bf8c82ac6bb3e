"""Named queries over the test tables, each with an independent DuckDB statement."""

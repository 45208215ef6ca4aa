"""Table-in, table-out jobs."""

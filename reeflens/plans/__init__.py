"""Named pipelines (Q1-Q32), chart tables and the query registry."""

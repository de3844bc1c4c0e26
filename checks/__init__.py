"""Raw feeds derived from the given tables, and the expected results in SQL."""

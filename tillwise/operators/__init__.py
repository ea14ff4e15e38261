"""Relational steps: cleaning, joins, aggregation, ranking, de-duplication, nesting, quality."""

"""Relational operators of the pipeline: joins, enrichment, rules, windowed metrics."""

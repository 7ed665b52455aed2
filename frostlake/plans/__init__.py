"""Plans: the batch pipeline, serving queries, free-SQL conformance, registry."""

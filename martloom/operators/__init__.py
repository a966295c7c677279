"""Reusable DataFrame operators: filters, joins, partitions, loads, lookups, shards."""

"""Readers: delimited files with a reject limit, database tables, month-partitioned tables."""

"""Queries over the supplied test tables and their SQL twins."""

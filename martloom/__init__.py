"""Retail mart pipeline expressed as Spark DataFrame jobs."""

"""Loads that follow files as they arrive."""

"""Operators for building training data: language, duplicates, personal data, packing and more."""

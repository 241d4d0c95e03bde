"""Operators for cleaning and packing large text corpora."""

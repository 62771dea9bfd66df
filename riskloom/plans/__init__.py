"""Whole jobs, and the query catalog over the driver tables."""

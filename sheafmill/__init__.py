"""Metadata-harvest analytics on Spark: sources, normalisation, merges, reports and search as DataFrame operations."""

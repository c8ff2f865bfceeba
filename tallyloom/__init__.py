"""Spark jobs for large panels of monthly time series."""

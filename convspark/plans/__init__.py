"""Whole jobs, from source table to written data set or result table."""

"""Queries over the driver tables, each with the SQL it must agree with."""

"""Queries over the driver tables, each with the SQL that states the same result."""

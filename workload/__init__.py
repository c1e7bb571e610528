"""Queries over the given tables, one per operator, with the SQL to check them by."""

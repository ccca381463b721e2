"""Queries over the supplied tables, each with the SQL it is held against."""

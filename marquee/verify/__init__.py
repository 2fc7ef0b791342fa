"""Registered checks over the driver tables: shapes, queries and their SQL twins."""

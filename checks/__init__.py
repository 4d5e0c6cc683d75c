"""Queries that exercise every operator over the given tables, each with its SQL."""

"""Queries over the provided tables, one per operator, with their SQL twins."""

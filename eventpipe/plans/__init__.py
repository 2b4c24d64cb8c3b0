"""Queries over the two tables, and whole batch plans from topic to tables."""

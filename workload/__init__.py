"""Queries over the driver tables: one per operator, each with a SQL form for a second engine."""

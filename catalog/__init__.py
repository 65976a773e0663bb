"""Queries over the driver's test tables, and the same questions in plain SQL."""

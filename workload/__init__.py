"""Queries over the test tables, and the same questions in plain SQL."""

"""Whole jobs: sources to tables, tables to warehouse, analyst questions."""

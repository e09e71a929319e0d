"""Readers: CSV folders, workbooks, rule files and seed tables."""

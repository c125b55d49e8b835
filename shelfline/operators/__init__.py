"""Batch operators: each one is a DataFrame -> DataFrame function."""

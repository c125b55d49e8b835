"""Retail price intelligence on PySpark: batch and streaming DataFrame operators."""

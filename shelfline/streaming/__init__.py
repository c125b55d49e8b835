"""Structured Streaming operators; most also accept static frames."""

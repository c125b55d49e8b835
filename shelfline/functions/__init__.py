"""Column helpers and skew-safe ordered-group helpers."""

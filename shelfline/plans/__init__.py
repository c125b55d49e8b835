"""Compositions: fixture mapping, layer jobs and the registered query catalogue."""

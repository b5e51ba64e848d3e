"""Readers. Every reader keeps or creates an explicit order column; none relies on row order."""

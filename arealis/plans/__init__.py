"""Composed country jobs."""

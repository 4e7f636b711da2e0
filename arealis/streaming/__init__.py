"""Streaming publication."""

"""Scans of landed files and pages."""

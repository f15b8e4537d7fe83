"""Scans and sinks for landed files."""

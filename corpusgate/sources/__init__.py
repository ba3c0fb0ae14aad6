"""Scans, transport checks and sinks."""

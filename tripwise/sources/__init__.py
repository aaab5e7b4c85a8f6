"""Scans, sinks and typed loads."""

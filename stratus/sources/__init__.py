"""Scans, sinks and reference tables."""

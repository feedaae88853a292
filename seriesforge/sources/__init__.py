"""Scans, landing parsers and sinks."""

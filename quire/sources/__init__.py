"""Scans, landed-file readers and table sinks."""

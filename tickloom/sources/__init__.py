"""Scans, sinks, merges and pluggable sources."""

"""Scans, sinks and digests."""

"""Scans, sinks and the storage they share."""

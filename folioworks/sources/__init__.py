"""Scans over landed payloads."""

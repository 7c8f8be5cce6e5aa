"""Parsers from landed payloads to artifact rows."""

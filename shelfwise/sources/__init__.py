"""Scans, sinks, declared schemas and the test-data adapter."""

from shelfwise.sources import fixtures, io, schemas

__all__ = ["fixtures", "io", "schemas"]

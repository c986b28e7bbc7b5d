"""Readers: landed API responses (JSON), event/search tables, dimensions, and
the stand-in views derived from the driver tables."""

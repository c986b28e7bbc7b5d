"""Relational building blocks of the jobs (overlay, fallback, reconcile, blend)."""

"""User-facing jobs: each builds one lazy plan and (optionally) writes it."""

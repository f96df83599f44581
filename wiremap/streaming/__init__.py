"""Structured Streaming jobs: raw -> bronze, bronze -> silver, gold refresh."""

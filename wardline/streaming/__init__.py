"""Structured Streaming jobs: one-parse fan-out ingest and warehouse copy."""

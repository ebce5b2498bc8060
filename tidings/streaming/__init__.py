"""Structured Streaming jobs: continuous ingest, exact-id dedup inside a horizon, windowed counts."""

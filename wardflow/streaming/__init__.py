"""Structured Streaming jobs: ingest, continuous upsert, load history."""

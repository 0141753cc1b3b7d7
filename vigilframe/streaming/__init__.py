"""Structured Streaming forms of ingest, aggregates and detectors."""

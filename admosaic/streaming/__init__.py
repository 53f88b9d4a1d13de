"""Structured Streaming: ingest of landed pages and quota accounting on a stream of fetches."""

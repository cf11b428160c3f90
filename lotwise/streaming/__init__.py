"""Structured Streaming: event topics, event-driven ETL and serving refresh."""

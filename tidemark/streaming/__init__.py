"""Event-driven retention triggers on Structured Streaming."""

"""Structured Streaming: per-key state, changing dimensions, starting queries."""

"""Structured Streaming forms: new-export arrival, incremental monthly routing, streaming dedup."""

"""Structured Streaming forms: TTL dedup processor, metrics stream, staged job with late routing."""

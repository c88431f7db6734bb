"""Structured Streaming: the live price-tick feed."""

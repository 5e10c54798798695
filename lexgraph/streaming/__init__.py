"""Structured Streaming extension: recompute layers as files land."""

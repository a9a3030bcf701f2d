"""Flows on Structured Streaming: routing, per-batch groups, keyed state, windowed counts, whole flows."""

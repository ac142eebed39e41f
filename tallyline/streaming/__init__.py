"""Structured Streaming jobs: incremental decode and keyed state."""

"""Structured Streaming jobs and the keyed stateful processors."""

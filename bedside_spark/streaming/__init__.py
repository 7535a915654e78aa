"""Structured Streaming jobs and keyed-state operators."""

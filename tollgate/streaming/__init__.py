"""Structured Streaming: sources, the pre-process job, windowed metrics, monitoring."""

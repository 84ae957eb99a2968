"""The two Structured Streaming jobs."""

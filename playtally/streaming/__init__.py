"""File arrival as a Structured Streaming query."""

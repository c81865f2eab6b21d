"""Structured Streaming: watermarked windows and sessions, and the two jobs."""

"""Structured Streaming jobs over the ad click log."""

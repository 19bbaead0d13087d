"""Observations of many runs as a stream."""

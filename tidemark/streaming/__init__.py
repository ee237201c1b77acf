"""Structured Streaming jobs over message directories."""

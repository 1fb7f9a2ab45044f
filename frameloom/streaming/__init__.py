"""Structured Streaming transforms."""

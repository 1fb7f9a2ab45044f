"""Readers and writers of clips."""

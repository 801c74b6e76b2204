"""Batch readers and writers."""

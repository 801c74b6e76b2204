"""Reusable DataFrame building blocks, generic over column names."""

"""Operators over counts, intervals and calls."""

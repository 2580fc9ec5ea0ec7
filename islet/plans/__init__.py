"""Whole runs: sources to result tables."""

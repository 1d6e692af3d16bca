"""Sinks: every result is written as many part files, one task each, and committed once."""

"""Readers, writers and the declared source types."""

"""Readers and extractors."""

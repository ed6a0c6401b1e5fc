"""Adapters and end-to-end plans."""

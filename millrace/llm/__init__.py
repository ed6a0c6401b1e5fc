"""Operators for preparing training corpora (sharding, filtering, dedup, mixing, ...).

Nothing outside this subpackage imports it.
"""

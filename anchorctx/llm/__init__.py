"""Operators for preparing training text: sharding, fingerprints, filters, dedup, tokens."""

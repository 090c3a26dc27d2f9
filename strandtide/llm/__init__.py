"""Operators for preparing training text: sharding, quality, overlap, archives, fingerprints, mixing, secrets, token files."""

"""Operators for preparing training data: mixing, language, personal data, archives,
near-duplicates, quality, neighbours, repeated substrings, fingerprints, tokens."""

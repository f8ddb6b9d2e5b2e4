"""Operators for preparing training data: encoding, duplicates, filtering, formatting."""

"""Operators for preparing training text: archives, duplicates, scoring, fingerprints, search and packing."""

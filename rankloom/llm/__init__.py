"""Operators that prepare training text: packing, scoring, secret scans, language, decontamination, near-duplicates,
resharding, page extraction, ranked search, embedding near-duplicates and clustering.
Nothing else in the library imports this package."""

"""Operators for large text corpora: classifiers, fingerprints, duplicates, models, searches."""

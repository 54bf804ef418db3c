"""Operators for preparing training data: token files, near-duplicates, classifiers, packing."""

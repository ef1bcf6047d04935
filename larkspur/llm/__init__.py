"""Operators for training-data corpora. Nothing else in larkspur imports this package."""

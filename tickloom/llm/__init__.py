"""Operators for preparing text corpora. Nothing else in the package depends on them."""

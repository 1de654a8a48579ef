"""Operators for large-scale training data: linking, canonical text, survivors, leaks, mixtures and quality."""

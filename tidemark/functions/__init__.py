"""Scalar expressions: text, names, addresses, numbers."""

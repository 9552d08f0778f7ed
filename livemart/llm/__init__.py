"""Operators for large-scale training-data preparation (one module each)."""

"""Operators for training-data texts and records. Nothing outside this package imports it."""

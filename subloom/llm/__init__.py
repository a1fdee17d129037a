"""Operators for training-data text; optional, nothing else in the library imports it."""

"""Readers: file bytes to line tables, events and records."""

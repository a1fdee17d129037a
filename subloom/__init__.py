"""Subtitle-corpus engine expressed as Spark DataFrame and Column operations."""

"""Operators on streams."""

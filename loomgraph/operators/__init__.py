"""Operators on records, quads and property graphs."""

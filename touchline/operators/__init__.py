"""Relational operators of the reporting tables (shuffles live here)."""

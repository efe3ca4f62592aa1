"""Batch entry points (initial load, daily update) and the query catalog."""

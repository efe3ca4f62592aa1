"""Scans and sinks: day-partitioned raw shards, derived tables, and the
adapter that shapes the driver's test tables into the raw export schema."""

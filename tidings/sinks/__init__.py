"""Sinks: digests, stage tables, metrics and the archive layout, written as partitioned files."""

"""Readers, sinks and the mapping of benchmark tables to the reserving domain."""

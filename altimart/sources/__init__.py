"""Readers, schemas, sinks and the mapping from the driver tables to the twelve sheets."""

"""Readers, schemas, row ids and sinks."""

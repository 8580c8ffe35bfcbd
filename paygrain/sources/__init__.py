"""Readers, registries and sinks."""

"""Readers, parsers, the zone dimension and sinks."""

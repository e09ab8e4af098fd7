"""Readers, staging and sinks."""

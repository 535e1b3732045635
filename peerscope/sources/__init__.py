"""Readers for the delimited, fixed-width and multi-file inputs, and sinks."""

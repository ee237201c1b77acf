"""Readers for archived tables, text products and JSON payloads, and the table sinks."""

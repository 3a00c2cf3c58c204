"""Readers with declared types, and parquet sinks."""

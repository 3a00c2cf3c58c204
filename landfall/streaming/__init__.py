"""Incremental loading of new arrival files."""

"""Composed jobs: the pipeline, the analyst queries and the registered queries."""

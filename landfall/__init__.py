"""Landfall: a star schema of visitor arrivals, built as Spark DataFrame jobs."""

"""Bulk and streaming media annotation as Spark DataFrame jobs."""

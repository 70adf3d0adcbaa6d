"""Governed analytics on tabular data, written as Spark DataFrame jobs."""

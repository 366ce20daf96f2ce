"""Ensemble forecast analytics expressed as Spark DataFrame jobs."""

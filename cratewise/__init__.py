"""Cratewise: catalogue canonicalisation as Spark DataFrame jobs."""

"""Allocation bases, dimension building and order publication as Spark DataFrame jobs."""

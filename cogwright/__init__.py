"""Catalog analytics as Spark jobs."""

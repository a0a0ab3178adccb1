"""Catalogue profiling as Spark jobs."""

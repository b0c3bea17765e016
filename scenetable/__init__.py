"""Spark analytics over captured 3D scenes held as tables."""

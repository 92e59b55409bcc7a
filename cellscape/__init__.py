"""Spatial grid and land-change analytics as Spark DataFrame operators."""

"""Burned-area and land-cover analytics as lazy Spark DataFrame pipelines."""

__version__ = "0.1.0"

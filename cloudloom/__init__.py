"""Spatial sensor analytics and training-data preparation as ordinary Spark jobs."""

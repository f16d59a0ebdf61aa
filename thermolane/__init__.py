"""Spark-native building-energy analytics: ingest, cleaning, zone features, limits and planning."""

__version__ = "0.1.0"

"""tidemark — a Spark-native medallion pipeline for market ticks and orders."""

__version__ = "0.1.0"

"""Spark-native curation of raster-asset training corpora."""

__version__ = "0.1.0"

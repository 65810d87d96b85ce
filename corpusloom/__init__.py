"""Parallel-corpus curation expressed as Spark DataFrames."""

__version__ = "0.1.0"

"""Spark-native analytics for an online shop's logs and database changes.

Operators are plain functions from DataFrames to DataFrames.  The same function runs in batch over
Parquet and, where the operator has a streaming meaning, inside Structured Streaming.
"""

__version__ = "0.1.0"

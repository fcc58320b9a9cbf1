"""Table operators and medallion pipelines for retail-style analytics on Spark."""

__version__ = "0.1.0"

"""barsmith: OHLCV bar features and data quality as Spark DataFrame jobs."""

__version__ = "0.1.0"

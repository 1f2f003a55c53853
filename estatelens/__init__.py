"""estatelens - Spark-native analytics for real-estate brokerage data."""

__version__ = "0.1.0"

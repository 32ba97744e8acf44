"""mergestone: a Spark-native engine for typed, keyed and versioned tables."""

__version__ = "0.1.0"

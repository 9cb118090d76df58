"""lexigrid: a Spark-native engine for multilingual lexical data."""

__version__ = "0.1.0"

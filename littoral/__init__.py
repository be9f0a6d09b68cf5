"""littoral: a Spark-native engine for enriching polygon datasets from regional extracts."""

__version__ = "0.1.0"

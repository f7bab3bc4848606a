"""millrace: a PySpark-native change-data-capture apply engine."""

__version__ = "0.1.0"

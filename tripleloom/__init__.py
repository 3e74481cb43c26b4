"""tripleloom: Spark-native ingestion of metadata dumps into a triple table, and its queries."""

__version__ = "0.1.0"

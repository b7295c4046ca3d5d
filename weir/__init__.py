"""Spark-native ingestion, table maintenance and log analytics."""

"""Spark-native curation and analytics for grouped record collections."""

"""Spark-native operators for evidence-backed curation of text and tables."""

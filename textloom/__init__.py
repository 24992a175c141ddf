"""Spark-native preparation and analysis of large text corpora."""

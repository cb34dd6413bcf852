"""Spark-native engine for building and analysing corpora of documents."""

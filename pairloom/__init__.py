"""Spark-native preparation of aligned text datasets from document corpora."""

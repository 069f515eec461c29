"""Strandline: a Spark-native engine for archived-web corpora."""

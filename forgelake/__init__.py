"""Spark-native operators for captured code-collaboration records."""

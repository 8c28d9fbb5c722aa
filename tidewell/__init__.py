"""Tidewell: a Spark-native medallion engine and corpus toolkit."""

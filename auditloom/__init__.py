"""Spark-native operators for building and auditing software-engineering benchmark datasets."""

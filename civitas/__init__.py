"""Spark-native analytics over snapshots of public petition records."""

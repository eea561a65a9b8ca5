"""Spark-native processing of live-event listings."""

"""Spark-native reconciliation and judging of many feeds about the same events."""

"""Spark-native ELT operators: scans, loads, staging columns, checks, exports, streams and jobs."""

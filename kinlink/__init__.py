"""Kinlink: record linkage and corpus preparation on Spark."""

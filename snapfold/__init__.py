"""Snapshot-lifecycle analytics on Spark DataFrames."""

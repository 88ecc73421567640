"""Batch feature engine for trip punctuality data, built on Spark DataFrames."""

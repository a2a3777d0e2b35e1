"""Foreground-concurrency analytics on Spark DataFrames."""

"""Interval, sequence and evidence analytics on Spark DataFrames."""

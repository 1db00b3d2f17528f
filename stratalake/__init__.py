"""Batch lakehouse analytics on Spark DataFrames: raw -> bronze -> silver -> gold -> marts."""

"""Incremental lake tables and sales analytics on Spark DataFrames."""

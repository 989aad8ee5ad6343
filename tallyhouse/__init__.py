"""Batch order warehouse on Spark DataFrames: quality rules, incremental facts, dimensions, trends."""

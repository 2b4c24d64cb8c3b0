"""Event processing and analytics on Spark DataFrames and Structured Streaming."""

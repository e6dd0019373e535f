"""DNS and internet-access log analytics on Spark DataFrames and Structured Streaming."""

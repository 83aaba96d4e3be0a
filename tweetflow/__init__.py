"""Tweet and ad-event analytics on Spark DataFrames, the same functions in batch and in streaming."""

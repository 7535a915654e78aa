"""Patient-monitoring analytics on Spark DataFrames, batch and streaming."""

"""Daily listening analytics on Spark DataFrames."""

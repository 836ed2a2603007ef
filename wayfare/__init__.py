"""Transit operations analytics on Spark DataFrames."""

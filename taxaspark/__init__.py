"""taxaspark: short-read community profiling and training-data operators on Spark DataFrames."""

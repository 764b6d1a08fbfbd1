"""Frame-indexed detection analytics and training-data preparation on Spark DataFrames."""

"""Flow analytics and scan detection on Spark DataFrames."""

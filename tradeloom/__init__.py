"""Bronze / Silver / Gold analytics for distribution sales, on Spark DataFrames."""

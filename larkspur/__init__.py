"""larkspur: record linkage and tabular analytics on Spark DataFrames."""

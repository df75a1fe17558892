"""daytally: daily incident analytics on Spark DataFrames and Spark ML."""

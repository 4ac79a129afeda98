"""tallyloom: sales and retail analytics on Spark DataFrames."""

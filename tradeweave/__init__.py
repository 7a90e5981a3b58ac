"""Entity mapping and data quality on Spark DataFrames."""

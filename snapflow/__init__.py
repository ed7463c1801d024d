"""snapflow: incremental snapshot maintenance on Spark DataFrames."""

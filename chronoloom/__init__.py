"""Time-domain event analytics and corpus preparation on Spark DataFrames."""

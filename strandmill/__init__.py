"""strandmill: structural-variant analytics and corpus preparation on Spark DataFrames."""

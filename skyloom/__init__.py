"""skyloom: station and provider time series on Spark DataFrames."""

"""Market-bar panels and event series as lazy Spark DataFrames."""

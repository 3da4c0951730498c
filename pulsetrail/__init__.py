"""Event-log analytics on Spark: DataFrames in, DataFrames out."""

"""takepick: prepare, label and score candidate takes with Spark DataFrames."""

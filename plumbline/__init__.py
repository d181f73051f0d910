"""plumbline: analytics for matching noisy labelled records against reference geometry, on Spark DataFrames."""

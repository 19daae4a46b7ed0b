"""featureflow: feature preparation, data quality, drift and regression on Spark DataFrames."""

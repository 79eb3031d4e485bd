"""Lead-funnel and sales star schema on Spark DataFrames."""

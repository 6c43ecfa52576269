"""Evidence-graph analytics on Spark DataFrames."""

"""strandline: sequence-classification analytics on Spark DataFrames."""

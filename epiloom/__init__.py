"""Single-cell DNA-methylation analytics on Spark DataFrames."""

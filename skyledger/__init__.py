"""skyledger: near-Earth-object and satellite-catalog analytics on Spark DataFrames."""

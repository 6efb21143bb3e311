"""cellweave: geospatial fusion analytics and corpus operators on Spark DataFrames."""

"""contentlake: data-quality and incremental medallion operators on Spark DataFrames."""

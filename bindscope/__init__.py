"""Campaign analytics on Spark: joins, gates, rankings and geometry as DataFrames."""

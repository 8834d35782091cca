"""Market-bar analytics on Spark: every operator takes and returns a DataFrame."""

"""rowcast: DataFrame-to-DataFrame analytics on Spark."""

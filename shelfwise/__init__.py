"""Shop comparison analytics on Spark: stored pages and typed feeds to comparable tables."""

"""Price analytics on Spark: cleaning, star tables, statistics, views and price models."""

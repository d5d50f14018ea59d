"""A Spark-first engine for ranked candidate funnels."""

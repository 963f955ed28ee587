"""Social-feed analytics on Spark: bronze JSON -> silver -> gold -> warehouse."""

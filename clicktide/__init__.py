"""Click and checkout analytics on Spark: one DataFrame transform per operator, batch and streaming alike."""

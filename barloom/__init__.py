"""barloom: point-in-time market features for many instruments at once, on Spark."""

"""Spark-first record linkage: blocking, pair features, decisions and their evaluation as DataFrame plans."""

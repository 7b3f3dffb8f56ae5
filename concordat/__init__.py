"""Spark-first engine for SQL dialect translation, catalog modelling and data parity."""

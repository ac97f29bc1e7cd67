"""Spark jobs over the driver's tables. See README.md for the scope."""

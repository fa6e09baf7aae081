"""Daily price analytics as plain DataFrame -> DataFrame functions on Spark."""

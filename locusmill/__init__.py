"""Variant annotation and cohort analytics as plain Spark DataFrame code."""

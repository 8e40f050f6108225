"""Operational-exception analytics as plain Spark DataFrame transformations."""

"""Retail transaction analytics as lazy Spark DataFrame transforms."""

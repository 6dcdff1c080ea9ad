"""Batch trip analytics as Spark DataFrame operators."""

"""Delivery analytics as Spark DataFrame operators."""

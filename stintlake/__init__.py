"""Motorsport timing and tyre-strategy analytics as Spark DataFrame operators."""

"""Behavioural recommendation analytics as PySpark DataFrame operators."""

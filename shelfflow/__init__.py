"""Retail inventory analytics as PySpark DataFrame functions."""

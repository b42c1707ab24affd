"""Batch analytics on PySpark: reusable functions from DataFrame to DataFrame."""

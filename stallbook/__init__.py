"""Retail data pipeline and analytics as plain PySpark DataFrame functions."""

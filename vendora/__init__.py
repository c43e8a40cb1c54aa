"""Marketplace commerce analytics as PySpark DataFrame functions."""

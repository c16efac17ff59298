"""Tillwright: a retail sales mart and customer analytics as PySpark DataFrame functions."""

__version__ = "0.1.0"

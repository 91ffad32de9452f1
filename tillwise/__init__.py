"""Retail operations analytics as lazy Spark DataFrame plans."""

from tillwise.model import RetailTables

__all__ = ["RetailTables"]

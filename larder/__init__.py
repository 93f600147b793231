"""Retail demand, waste and discount analytics expressed as Spark plans."""

__version__ = "0.1.0"

"""Cardmill: audited tables from archives of semi-structured document cards, on Spark."""

__version__ = "0.1.0"

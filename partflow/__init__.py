"""Demand-analytics operators for spare-parts planning, built on PySpark DataFrames."""

__version__ = "0.1.0"

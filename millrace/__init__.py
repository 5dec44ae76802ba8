"""Analytical query and table-change operators for PySpark."""

__version__ = "0.1.0"

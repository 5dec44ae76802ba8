"""Operators bound to the driver's tables, each with its comparison SQL.

Query outputs use bigint, double and string only, so that both engines hash
alike: money is summed as decimal(18,2) and shown as double, dates are ISO text.
"""

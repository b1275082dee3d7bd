"""Operators: functions from DataFrames to DataFrames, one module a domain."""

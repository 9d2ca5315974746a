"""Operators: functions from DataFrames to one DataFrame, without input or output."""

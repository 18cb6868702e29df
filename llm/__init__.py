"""Operators of a training-data pipeline: functions from DataFrames to DataFrames."""

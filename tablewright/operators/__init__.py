"""Operators: functions from DataFrame to DataFrame, or to a fitted model."""

"""Operators: functions from DataFrame to DataFrame with column roles as parameters."""

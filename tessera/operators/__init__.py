"""Operators: functions from DataFrame to DataFrame, for ``df.transform``."""

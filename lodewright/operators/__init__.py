"""Operators: functions from DataFrame to DataFrame, lazy and without driver collects."""

"""Operators: functions from DataFrame to DataFrame, for tables and streams alike unless noted."""

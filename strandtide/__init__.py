"""Sequence and metadata analytics as Spark DataFrame operators.

Every operator is a function from DataFrame to DataFrame (or Column to Column).
"""

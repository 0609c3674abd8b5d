"""Operators: each a DataFrame -> DataFrame function."""

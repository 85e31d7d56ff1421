"""Operators: each is a function DataFrame -> DataFrame."""

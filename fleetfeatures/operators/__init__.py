"""Operators: plain ``DataFrame -> DataFrame`` functions with column names as parameters."""

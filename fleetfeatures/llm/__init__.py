"""Operators for text training data. Nothing outside this subpackage imports it."""

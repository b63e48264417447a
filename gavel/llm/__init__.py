"""Operators for preparing text and records as training data. Nothing outside this subpackage imports it."""

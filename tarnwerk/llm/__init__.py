"""Operators for training text; nothing outside this subpackage imports it."""

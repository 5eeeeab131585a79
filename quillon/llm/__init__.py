"""Operators for large-scale text preparation. Nothing outside this subpackage imports it."""

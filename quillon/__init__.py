"""Quillon: a PySpark-native engine for evidence text, graphs, rules and laboratory observations."""

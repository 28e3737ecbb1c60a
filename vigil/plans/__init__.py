"""Composed builds, report sets and the registered query catalog."""

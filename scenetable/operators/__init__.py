"""Operators of the scene library."""

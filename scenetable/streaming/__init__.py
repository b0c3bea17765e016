"""Streaming of the scene library."""

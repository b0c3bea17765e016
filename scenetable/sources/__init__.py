"""Sources of the scene library."""

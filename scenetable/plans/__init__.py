"""Plans of the scene library."""

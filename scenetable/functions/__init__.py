"""Functions of the scene library."""

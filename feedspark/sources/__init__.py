"""Sources of the library."""

"""Plans of the library."""

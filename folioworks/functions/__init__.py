"""Column helpers, all built from native expressions."""

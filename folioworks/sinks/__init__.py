"""Contract-checked writers."""

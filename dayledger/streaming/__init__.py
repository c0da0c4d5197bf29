"""Loading reports as they arrive."""

"""Loading files as they arrive."""

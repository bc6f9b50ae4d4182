"""clickweave."""

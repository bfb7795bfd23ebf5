"""operators package."""

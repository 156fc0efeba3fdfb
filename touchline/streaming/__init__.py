"""Live game streams."""

"""operators of parlance."""

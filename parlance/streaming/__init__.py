"""streaming of parlance."""

"""sources of parlance."""

"""functions of parlance."""

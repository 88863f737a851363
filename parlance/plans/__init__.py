"""plans of parlance."""

"""ml."""

"""Column functions; see scalars."""

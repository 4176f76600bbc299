"""The operators put together on the given tables."""

"""DataFrame operators over nested tables."""

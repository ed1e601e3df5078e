"""tidings.sources."""

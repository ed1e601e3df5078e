"""tidings.functions."""

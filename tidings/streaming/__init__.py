"""tidings.streaming."""

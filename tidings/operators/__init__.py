"""tidings.operators."""

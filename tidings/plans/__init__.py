"""tidings.plans."""

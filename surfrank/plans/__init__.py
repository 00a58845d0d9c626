"""surfrank plans."""

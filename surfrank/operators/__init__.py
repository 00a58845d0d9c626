"""surfrank operators."""

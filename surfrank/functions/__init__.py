"""surfrank functions."""

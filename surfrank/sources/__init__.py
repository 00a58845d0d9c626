"""surfrank sources."""

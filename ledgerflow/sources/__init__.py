"""Sources of the money-flow engine."""

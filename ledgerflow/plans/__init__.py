"""Plans of the money-flow engine."""

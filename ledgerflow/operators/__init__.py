"""Operators of the money-flow engine."""

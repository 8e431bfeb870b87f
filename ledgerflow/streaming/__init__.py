"""Streaming of the money-flow engine."""

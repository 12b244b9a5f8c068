"""Streaming use of the stateless operators (no stateful operators: the
reference has none)."""

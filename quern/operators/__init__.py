"""Operators of the quern engine."""

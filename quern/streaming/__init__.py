"""Streaming of the quern engine."""

"""Plans of the quern engine."""

"""Sources of the quern engine."""

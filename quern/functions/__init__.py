"""Functions of the quern engine."""

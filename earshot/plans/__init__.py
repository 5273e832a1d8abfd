"""Jobs and analyses composed from the operators."""

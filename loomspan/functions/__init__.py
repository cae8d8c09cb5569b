"""Part of the loomspan engine."""

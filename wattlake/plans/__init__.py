"""Multi-step flows built from the operators."""

"""Domain pipelines (D1-D25): compositions of the operators."""

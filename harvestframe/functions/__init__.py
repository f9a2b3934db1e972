"""Column-expression helpers and the feature families."""

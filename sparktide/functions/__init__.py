"""Scalar column functions with the semantics the operators promise."""

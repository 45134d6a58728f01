"""Scalar Column functions (all built-in Spark expressions, codegen eligible)."""

"""Scalar functions as Column expressions; Arrow functions only where Spark has no built-in."""

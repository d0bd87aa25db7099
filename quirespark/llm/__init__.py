"""Operators for the preparation of training data; nothing outside imports this."""

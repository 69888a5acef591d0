"""Operators for training data and record linkage; nothing else in the library imports this."""

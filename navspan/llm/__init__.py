"""Operators for corpora of training text. Nothing else in the library imports this package."""

"""Operators for building training data from text collections. Nothing else in the library imports this package."""

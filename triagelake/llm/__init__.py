"""Operators for building training data from web documents."""

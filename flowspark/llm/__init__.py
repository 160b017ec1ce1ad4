"""Operators for preparing training data: thirteen of them, each in a module of its own."""

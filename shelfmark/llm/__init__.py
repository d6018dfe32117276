"""Operators for preparing language-model training text."""

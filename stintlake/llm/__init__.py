"""Operators for preparing the text of a training corpus; nothing else in the library imports this package."""

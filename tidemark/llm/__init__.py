"""Operators for training text and time matching; nothing else in the library imports this."""

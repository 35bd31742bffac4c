"""Operators that prepare text collections for training; nothing else in the library imports them."""

"""Operators that prepare training text and data.  Nothing else in the library imports them."""

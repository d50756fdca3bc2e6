"""Operators over training documents and raw pages; nothing else in the library imports them."""

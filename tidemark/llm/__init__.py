"""Operators for preparing language-model training data; the rest of the library does not use them."""

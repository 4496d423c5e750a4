"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Each module states its method, what it returns for nulls, empty
texts and repeated rows, and what its memory is bounded by.
"""

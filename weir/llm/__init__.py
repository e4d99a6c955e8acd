"""Operators for preparing language-model training data.

Nothing else in the library imports this package. Every operator takes a
DataFrame and returns a DataFrame; the `opN_*` queries are in `queries`.
"""

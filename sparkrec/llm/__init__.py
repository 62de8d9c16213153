"""Operators for training-data pipelines over ``documents``-like tables.

Nothing else in the library imports this subpackage. Every operator takes a
DataFrame, selects the columns it needs by name (other columns, whatever
they are called, neither reach it nor clash with its own) and returns its
own columns only.
"""

"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Each module states how it
treats nulls, empty and very long texts, ties, repeated rows, empty tables and
extra columns.  Functions of this package reach executors with the task (see
``specflow/__init__.py``).
"""

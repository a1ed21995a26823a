"""Operators for preparing large text corpora.

Nothing else in the library imports this subpackage. Each operator module has
its own general interface; ``queries`` binds the operators to the corpus tables.
"""

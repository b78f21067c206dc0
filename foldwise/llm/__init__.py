"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it.  ``registry`` lists the
queries that apply the operators to the given tables.
"""

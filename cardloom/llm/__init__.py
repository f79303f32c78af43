"""Operators that prepare text corpora for model training.

Each module is one operator with its own general interface; ``queries`` binds
the operators to the test tables.  Nothing outside this subpackage imports it.
"""

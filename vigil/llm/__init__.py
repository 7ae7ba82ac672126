"""Operators for training-data pipelines (text, vectors, archives, pages).

Nothing else in the library imports this subpackage.  ``queries`` registers
one query per operator; the operators themselves keep general interfaces.
"""

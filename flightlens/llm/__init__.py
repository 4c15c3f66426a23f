"""Operators for building language-model training data from tables of documents.

Nothing else in the package imports this subpackage; the driver entry adds its
queries only when it can be imported.
"""

"""Operators for building training corpora from tables of documents.

Nothing outside this subpackage imports it.
"""

"""Operators for preparing training corpora, each with a registered query.

Nothing else in the library imports this subpackage.
"""

"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Each module holds one
operator (or a helper that several share); ``queries`` registers them over the
driver's tables.
"""

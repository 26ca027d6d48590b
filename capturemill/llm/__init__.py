"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Each module holds one operator with a general
interface; :mod:`capturemill.llm.queries` has the thin registered queries over the driver tables.
"""

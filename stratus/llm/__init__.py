"""Operators of a training-data pipeline over documents and pages.

Each module holds one operator with a general interface; :mod:`stratus.llm.queries`
binds them to the given tables. Nothing else in the library imports this package.
"""

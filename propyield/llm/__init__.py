"""Operators for preparing large text collections, as Spark jobs.

Nothing else in the library imports this package.
"""

"""Operators for preparing training text, their queries and comparison SQL.

Nothing else in the library imports this subpackage.
"""

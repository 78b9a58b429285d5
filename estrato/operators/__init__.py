"""Reusable DataFrame operators, independent of the banking model."""

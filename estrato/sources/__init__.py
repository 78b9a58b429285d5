"""Readers and writers: landing files, lake tables, logs, parameterised queries."""

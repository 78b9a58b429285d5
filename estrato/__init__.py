"""Layered (Bronze / Silver / Gold) banking analytics written as Spark jobs."""

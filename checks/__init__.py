"""Operators wired to the driver's tables, each with an independent SQL statement."""

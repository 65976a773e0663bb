"""Operators that work on any table, independent of the warehouse domain."""

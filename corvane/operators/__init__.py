"""Operators that Spark has no single function for, as compositions of DataFrame operations."""

"""Adapters from the given tables to the library's inputs, and the SQL to compare with."""

"""Queries of the library over the given tables, with the SQL they must agree with."""

"""Binding of the library to the test tables: domain objects, queries and their reference SQL."""

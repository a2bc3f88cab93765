"""Bindings of the test tables to the operators, and the catalogue of queries."""

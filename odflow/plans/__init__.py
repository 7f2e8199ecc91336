"""Compositions of the operators: the whole chain, and queries on given tables."""

"""Operators that prepare text corpora for model training.

Nothing outside this package imports it. Every operator reads and returns
DataFrames; ``queries`` registers one query per operator.
"""

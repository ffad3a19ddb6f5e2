"""Operators for building training data sets; `queries` registers one query for each of them."""

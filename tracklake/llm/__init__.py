"""Operators for preparing training data, one module each, and the queries that apply them."""

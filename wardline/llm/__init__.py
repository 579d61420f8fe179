"""Operators for preparing training data, the queries that apply them, and nothing the rest of the package needs."""

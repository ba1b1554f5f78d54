"""Operators that prepare a training corpus, and the queries that apply them."""

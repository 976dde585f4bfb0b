"""Operators that prepare text for the training of language models.

Each module holds one operator with an interface of its own; ``queries`` applies each to its
whole table. Nothing outside this subpackage imports it.
"""

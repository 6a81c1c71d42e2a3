"""Operators for preparing large text corpora: scoring, cleaning, deduplication, indexing, mixing, packing.

Nothing else in the library imports this package. Each module is one operator
with a general interface; ``queries.py`` registers one thin query per operator.
"""

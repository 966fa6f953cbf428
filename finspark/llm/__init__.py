"""Operators of a training-data pipeline (documents, pages, benchmark, labels).

Nothing else in the library imports this subpackage; ``queries`` holds the
catalogue entries and ``corpus_pipeline.py`` at the repository top chains
five of the operators.
"""

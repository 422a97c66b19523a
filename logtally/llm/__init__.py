"""Operators for preparing training corpora, each behind one module.

Nothing else in the library imports this package. ``queries.py`` registers one named
query per operator; ``corpus_pipeline.py`` at the repository top chains five of them.
"""

"""Operators of a training-data pipeline over a corpus of documents.

Each module holds one operator with its own general interface; ``queries``
registers the thin ``opN_<name>`` queries.  Nothing outside this folder and
``corpus_pipeline.py`` imports it.
"""

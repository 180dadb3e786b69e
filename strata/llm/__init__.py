"""Operators for preparing language-model training data.

One module per operator; ``queries`` registers the thin ``opN_<name>``
queries. Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""

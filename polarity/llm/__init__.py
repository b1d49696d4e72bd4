"""Operators of a training-data pipeline over documents, pages and benchmark items.

One module per operator; ``queries`` registers one query for each.  Nothing
outside this subpackage (and ``corpus_pipeline``) imports it.
"""

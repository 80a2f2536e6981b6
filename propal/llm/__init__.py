"""Operators of a training-data pipeline over ``documents`` (doc_id, text, lang, source, n_chars)
and ``embeddings`` (vec_id, embedding).

Nothing else in the library imports this subpackage.
"""

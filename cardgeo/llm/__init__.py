"""Operators of a training-data pipeline over the text tables: near-duplicate
search, tokenizing, packing, nearest neighbours, quality, language models,
chat formatting, toxicity, secrets and HTML extraction.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``queries`` binds them to the test tables.
"""

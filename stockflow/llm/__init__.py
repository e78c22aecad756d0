"""Operators for preparing training data: quality, language, tokens, near copies, packing, search.

Each module holds one operator; ``queries.py`` registers the thin queries over the test tables.
Nothing outside this package imports it.
"""

"""Training-data operators: quality, licences, tokens, pages, packing, duplicates, search.

Nothing else in the library imports this subpackage; its queries are
registered by `queries.py`.
"""

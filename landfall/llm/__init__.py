"""Operators for large training corpora: tokens, packing, quality, safety, duplicates, search.

Nothing else in the package imports this one. The operators are in one module each;
``queries`` applies them to the driver's tables.
"""

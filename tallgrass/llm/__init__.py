"""Training-data operators: scoring, packing, filtering, deduplication, archives and mixing.

Nothing else in the library imports this subpackage.
"""

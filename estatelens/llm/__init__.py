"""Training-data operators: filtering, deduplication, formatting, packing.

Nothing else in the library imports this subpackage.
"""

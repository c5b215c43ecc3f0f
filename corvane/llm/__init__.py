"""Training-data operators: language ID, dedup, packing, token files and the like.

Nothing outside this subpackage imports it, so it can be removed as a whole.
"""

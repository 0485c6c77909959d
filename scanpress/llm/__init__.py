"""Training-data operators: search, formatting, packing, joins, archives, language ID, LM scoring, token files, mixing, dedup.

Nothing else in the library imports this subpackage.
"""

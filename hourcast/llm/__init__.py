"""Training-data operators: deduplication, quality, tokens, packing, search and licences.

Every operator is a module of its own; ``queries`` registers one query per operator.
Nothing outside this subpackage imports it.
"""

"""Training-data operators: dedup, mixing, scoring, tokenising, formatting.

Nothing else in the package imports this subpackage.  Each module holds one
operator with a general interface; ``llm.queries`` derives the registered
query of each from it.
"""

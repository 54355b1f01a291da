"""Training-data operators: dedup, quality, tokenizers, mixing, archives, chat templates.

Nothing else in the library imports this package.
"""

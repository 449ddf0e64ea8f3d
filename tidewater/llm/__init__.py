"""Training-data operators: dedup, decontamination, tokens, quality, sharding.

One module per operator; ``queries.py`` registers the ``opN_`` queries. Nothing
else in the library imports this package.
"""

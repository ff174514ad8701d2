"""Training-data operators: whole-corpus jobs over document, page and conversation tables.

Nothing else in the library imports this package. Every module holds one
operator with its own general interface; ``queries`` holds the registered
queries.
"""

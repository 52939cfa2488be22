"""Operators that prepare text corpora for training language models.

Each module holds one operator, named by what it does.  ``queries`` applies them to the
given tables, ``sql`` has the same results as SQL where SQL can state them.
"""

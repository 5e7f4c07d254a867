"""Operators that prepare text, page and vector corpora for model training.

Nothing else in the package imports this subpackage.  Each module holds one
operator with a general interface; ``queries`` holds the thin registered
queries and ``oracles`` the SQL they are compared with.
"""

"""Corpus operators for training-data work: each module holds one operator, `queries` registers them.

Nothing outside this package imports it.
"""

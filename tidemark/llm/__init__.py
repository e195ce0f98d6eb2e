"""Operators that prepare text for the training of language models.

Each module holds one operator with a general interface; `queries` applies them to the
sample tables with production parameters. Nothing else in the library imports this folder.
"""

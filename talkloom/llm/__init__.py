"""Training-data operators for large text corpora.

Each module holds one operator with its own general interface; ``queries``
binds them to the tables of a data folder.  Nothing outside this subpackage
imports it.
"""

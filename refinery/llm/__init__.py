"""Operators for preparing large text collections for model training.

Each module holds one operator with its own general interface; ``queries.py``
registers one query per operator over the driver's tables.  Nothing outside
this package imports it.
"""

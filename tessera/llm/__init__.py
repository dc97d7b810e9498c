"""Operators for training-data pipelines (one module per operator).

Each module holds an operator with a general DataFrame interface; ``queries``
registers one query per operator over the supplied tables.
"""

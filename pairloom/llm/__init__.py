"""Operators of a training-data pipeline over text corpora.

Each module is one operator; ``queries`` applies them to the driver's tables.
Nothing else in the library imports this subpackage.
"""

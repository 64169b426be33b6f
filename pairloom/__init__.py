"""Preference data and query evaluation on Spark DataFrames.

``functions``  Column -> Column expressions (rendering, SQL text, cells)
``operators``  DataFrame -> DataFrame steps (splits, fixtures, verdicts, pairs, metrics)
``sources``    readers and writers of the record types in ``records``
``plans``      the operators put together into whole jobs
``streaming``  the stateless steps over a file stream
"""

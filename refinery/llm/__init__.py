"""Operators for preparing language-model training data, as Spark jobs.

Nothing outside this package imports it.  One module per operator, ``queries``
registers one query per operator over the whole test tables.
"""

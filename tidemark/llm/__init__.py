"""Operators for preparing text corpora at scale.

Nothing outside this package imports it.  ``queries()`` and ``oracle_sql()``
in :mod:`tidemark.llm.registry` are what the repository's entry file adds.
"""

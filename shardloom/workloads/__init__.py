"""Registered queries: the library's operators applied to the star-schema stand-in tables.

Every module offers ``QUERIES`` (name to ``(spark, folder) -> DataFrame``) and ``SQL`` (name to the
equivalent ANSI SQL, where there is one).
"""

from shardloom.workloads import feed, frame, log, media, metrics, models

_MODULES = (log, feed, frame, media, metrics, models)

QUERIES = {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}
SQL = {name: text for module in _MODULES for name, text in module.SQL.items()}

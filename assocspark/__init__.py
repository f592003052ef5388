"""Spark-native engine for genetic association result tables.

``schemas``    typed table registry
``functions``  Column expressions: clean-up, identifiers, dataset-to-resource rules
``sources``    text / JSON / block-gzip readers and table writers
``operators``  views, lookups, joins, interval joins, gene build, profiling, capped results
``plans``      the registered queries and their check SQL
"""

from assocspark.session import configure, new_session, scratch_dir

__all__ = ["configure", "new_session", "scratch_dir"]
